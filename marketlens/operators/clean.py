"""Cleaning of the nine source tables and the per-order rollups of payments
and reviews. Deduplication keeps a declared row (the smallest by all
columns) instead of relying on file order, so results do not depend on how
the input is split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import zero_pad
from ..functions.coerce import coerce
from ..sources.schemas import SOURCE_SCHEMAS

# Misspelt English category names and their corrections.
SPELLING_FIXES = {
    "fashio_female_clothing": "fashion_female_clothing",
    "costruction_tools_garden": "construction_tools_garden",
    "costruction_tools_tools": "construction_tools_tools",
}


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def dedupe_on(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the smallest row by all other columns. A min of a
    struct combines map-side, so a duplicated hot key costs no single task."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    return (df.groupBy(key).agg(F.min(F.struct(*others)).alias("__r"))
              .select(key, *[F.col(f"__r.{c}").alias(c) for c in others]))


def _typed(df: DataFrame, table: str) -> DataFrame:
    """Text columns of a source table that should be typed, coerced: frames
    that did not come through the CSV reader may hold them as text."""
    types = {f.name: f.dataType for f in SOURCE_SCHEMAS[table].fields if not isinstance(f.dataType, StringType)}
    return df.withColumns({c: coerce(c, t) for c, t in types.items()
                           if c in df.columns and isinstance(df.schema[c].dataType, StringType)})


def clean_customers(df: DataFrame) -> DataFrame:
    df = strip_column_names(df)
    df = df.withColumn("customer_zip_code_prefix", zero_pad(F.col("customer_zip_code_prefix")))
    return dedupe_on(df, "customer_id")


def clean_orders(df: DataFrame) -> DataFrame:
    return dedupe_on(_typed(df, "orders"), "order_id")


def clean_items(df: DataFrame) -> DataFrame:
    return _typed(df, "items")


def clean_sellers(df: DataFrame) -> DataFrame:
    df = df.withColumn("seller_zip_code_prefix", zero_pad(F.col("seller_zip_code_prefix")))
    return dedupe_on(df, "seller_id")


def clean_products(products: DataFrame, translation: DataFrame,
                   spelling_fixes: dict | None = None) -> DataFrame:
    """Left join of the (spell-fixed) English category name; products without
    a translation get 'unknown'. The original category column is kept."""
    fixes = SPELLING_FIXES if spelling_fixes is None else spelling_fixes
    tr = translation.select("product_category_name", "product_category_name_english")
    if fixes:
        tr = tr.replace(fixes, subset=["product_category_name_english"])
    out = products.join(tr, on="product_category_name", how="left")
    return out.withColumn("product_category_name_english",
                          F.coalesce(F.col("product_category_name_english"), F.lit("unknown")))


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Per order: total value, max installments, dominant payment type
    (most rows; ties to the type seen at the lowest payment_sequential, then
    by name) and number of payment rows."""
    df = _typed(payments, "payments")
    by_type = df.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("payment_sequential").alias("first_seq"),
        F.sum("payment_value").alias("v"),
        F.max("payment_installments").alias("inst"),
        F.count("payment_sequential").alias("seqs"))
    rank_key = F.when(F.col("payment_type").isNotNull(),
                      F.struct((-F.col("n")).alias("neg_n"), F.col("first_seq"), F.col("payment_type")))
    return by_type.groupBy("order_id").agg(
        F.coalesce(F.sum("v"), F.lit(0).cast("decimal(28,2)")).alias("total_payment_value"),
        F.max("inst").alias("payment_installments"),
        F.min_by("payment_type", rank_key).alias("payment_type"),
        F.sum("seqs").alias("payment_methods_count"))


def reviews_latest_per_order(reviews: DataFrame) -> DataFrame:
    """Latest review per order: for each column the last non-null value in
    creation-date order (rows without a date sort last, ties by review_id),
    the last non-null comments, and the number of review rows."""
    df = _typed(reviews, "reviews")
    order_key = F.struct(F.col("review_creation_date").isNull().cast("int").alias("undated"),
                         F.col("review_creation_date").alias("d"), F.col("review_id").alias("rid"))

    def last_non_null(c: str):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_key)).alias(c)

    cols = ["review_id", "review_score", "review_comment_title", "review_comment_message",
            "review_creation_date", "review_answer_timestamp"]
    present = [c for c in cols if c in df.columns]
    return df.groupBy("order_id").agg(*[last_non_null(c) for c in present],
                                      F.count("review_id").alias("review_event_count"))


def geolocation_by_zip(geo: DataFrame) -> DataFrame:
    """One row per zero-padded zip: exact median latitude / longitude and the
    most frequent city and state (ties alphabetical)."""
    from .stats import exact_quantiles
    g = geo.select(zero_pad(F.col("geolocation_zip_code_prefix")).alias("zip"), F.col("geolocation_lat").alias("lat"),
                   F.col("geolocation_lng").alias("lng"), F.col("geolocation_city").alias("city"),
                   F.col("geolocation_state").alias("state"))
    # both axes in one quantile call, both texts in one count
    axes = g.unpivot(["zip"], ["lat", "lng"], "axis", "v")
    med = exact_quantiles(axes, "v", {"m": 0.5}, keys=["zip", "axis"])
    pick = lambda value, name, key: F.max(F.when(F.col(key) == name, F.col(value))).alias(name)
    med = med.groupBy("zip").agg(pick("m", "lat", "axis"), pick("m", "lng", "axis"))
    texts = g.unpivot(["zip"], ["city", "state"], "what", "v")
    counts = texts.groupBy("zip", "what", "v").agg(F.count(F.lit(1)).alias("n"))
    # null texts stay, so that every zip has a row; they are never the mode
    modes = counts.groupBy("zip", "what").agg(F.min_by("v", F.when(F.col("v").isNotNull(), F.struct((-F.col("n")).alias("nn"), "v"))).alias("mode"))
    modes = modes.groupBy("zip").agg(pick("mode", "city", "what"), pick("mode", "state", "what"))
    return modes.join(med, "zip", "left").select(F.col("zip").alias("geolocation_zip_code_prefix"), "lat", "lng", "city", "state")
