"""Delivery and satisfaction deep-dive: overview, monthly delivery, state /
category / seller delivery with national benchmarks, and review score
distributions by delay bucket, state and category.

Scope: ``del_valid`` = delivered orders with a known late flag. National
figures are one-row aggregates attached by a broadcast of that single row.
Day-count medians and quartiles use Spark's exact ``percentile`` (bounded
domain: one counter per distinct day count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DELAY_EDGES, DELAY_LABELS, bucket_dimension, pct, right_closed_bucket, safe_div
from .marts import del_valid
from .stats import with_scalars, attach

MIN_SELLER_ORDERS = 50


def with_delay_bucket(df: DataFrame) -> DataFrame:
    return (df.withColumn("delay_bucket", right_closed_bucket(F.col("delivery_delay_days"), DELAY_EDGES, DELAY_LABELS))
              .withColumn("bucket_ord", right_closed_bucket(F.col("delivery_delay_days"), DELAY_EDGES,
                                                            DELAY_LABELS, ordinal=True)))


def national(master: DataFrame) -> DataFrame:
    """One row: national late %, mean delivery days, mean review over del_valid."""
    return del_valid(master).agg(
        (F.avg("is_late") * 100).alias("nat_late_pct"),
        F.avg("delivery_days").alias("nat_avg_days"),
        F.avg("review_score").alias("nat_review"))


def delivery_overview(master: DataFrame) -> DataFrame:
    dv = del_valid(master)
    g = dv.agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.coalesce(F.sum("on_time"), F.lit(0)).alias("on_time_count"),
        F.coalesce(F.sum("is_late"), F.lit(0)).alias("late_count"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.percentile("delivery_days", F.lit(0.5)).alias("median_delivery_days"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
        F.percentile("delivery_delay_days", F.lit(0.5)).alias("median_delay_days"))
    return (g.withColumn("on_time_pct", pct(F.col("on_time_count"), F.col("n_orders")))
             .withColumn("late_pct", pct(F.col("late_count"), F.col("n_orders"))))


def delay_bucket_counts(spark: SparkSession, master: DataFrame) -> DataFrame:
    """All seven buckets with their order counts over del_valid (0 when empty)."""
    counts = with_delay_bucket(del_valid(master)).groupBy("delay_bucket").agg(F.count(F.lit(1)).alias("order_count"))
    dim = bucket_dimension(spark, DELAY_LABELS, "delay_bucket")
    return F.broadcast(dim).join(counts, "delay_bucket", "left") \
        .withColumn("order_count", F.coalesce(F.col("order_count"), F.lit(0)))


def delivery_overview_with_buckets(spark: SparkSession, master: DataFrame) -> DataFrame:
    """Overview row plus a map bucket -> count (the JSON document form)."""
    ordered = F.sort_array(F.collect_list(F.struct("bucket_ord", "delay_bucket", "order_count")))   # 7 rows
    m = delay_bucket_counts(spark, master).agg(
        F.map_from_entries(F.transform(ordered, lambda s: F.struct(s["delay_bucket"], s["order_count"])))
        .alias("delay_bucket_counts"))
    return delivery_overview(master).transform(attach(m))


def delivery_over_time(master: DataFrame, min_orders: int = 50) -> DataFrame:
    g = del_valid(master).groupBy(F.col("purchase_month_label").alias("ym")).agg(
        F.count("order_id").alias("order_count"),
        F.coalesce(F.sum("on_time"), F.lit(0)).alias("on_time_count"),
        F.coalesce(F.sum("is_late"), F.lit(0)).alias("late_count"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.percentile("delivery_days", F.lit(0.5)).alias("median_delivery_days"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
        F.avg("review_score").alias("avg_review_score"))
    den = F.col("on_time_count") + F.col("late_count")
    return (g.withColumn("on_time_pct", pct(F.col("on_time_count"), den))
             .withColumn("late_pct", pct(F.col("late_count"), den))
             .where(F.col("order_count") >= min_orders))


def delivery_by_state_enriched(master: DataFrame, low_volume: int = 200) -> DataFrame:
    g = del_valid(master).where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("order_id").alias("order_count"),
        F.coalesce(F.sum("on_time"), F.lit(0)).alias("on_time_count"),
        F.coalesce(F.sum("is_late"), F.lit(0)).alias("late_count"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.percentile("delivery_days", F.lit(0.5)).alias("median_delivery_days"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
        F.avg("review_score").alias("avg_review_score"),
        F.percentile("delivery_days", F.lit(0.25)).alias("p25_delivery_days"),
        F.percentile("delivery_days", F.lit(0.75)).alias("p75_delivery_days"))
    den = F.col("on_time_count") + F.col("late_count")
    g = (g.withColumn("on_time_pct", pct(F.col("on_time_count"), den))
          .withColumn("late_pct", pct(F.col("late_count"), den))
          .withColumn("low_volume", F.col("order_count") < low_volume))
    return (with_scalars(g, national(master))
            .withColumn("late_vs_national", F.col("late_pct") - F.col("nat_late_pct"))
            .withColumn("delivery_vs_national", F.col("avg_delivery_days") - F.col("nat_avg_days"))
            .withColumn("review_vs_national", F.col("avg_review_score") - F.col("nat_review"))
            .drop("nat_avg_days", "nat_review"))


def high_impact_states(master: DataFrame, low_volume: int = 200) -> DataFrame:
    """States later than national and not low volume."""
    return high_impact_states_of(delivery_by_state_enriched(master, low_volume))


def high_impact_states_of(state_enriched: DataFrame) -> DataFrame:
    return state_enriched.where((F.col("late_pct") > F.col("nat_late_pct")) & ~F.col("low_volume"))


def delivery_by_category_enriched(first_cat: DataFrame, master: DataFrame, low_volume: int = 100) -> DataFrame:
    dv = del_valid(master).select("order_id", "delivery_days", "delivery_delay_days", "is_late", "on_time",
                                  "review_score")
    g = first_cat.join(dv, "order_id", "left").where(F.col("product_category_name_english").isNotNull()).groupBy("product_category_name_english").agg(
        F.count("order_id").alias("order_count"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.percentile("delivery_days", F.lit(0.5)).alias("median_delivery_days"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
        F.coalesce(F.sum("is_late"), F.lit(0)).alias("late_count"),
        F.coalesce(F.sum("on_time"), F.lit(0)).alias("on_time_count"),
        F.avg("review_score").alias("avg_review_score"))
    g = g.withColumn("late_pct", pct(F.col("late_count"), F.col("late_count") + F.col("on_time_count")))
    nat = national(master).select("nat_late_pct")
    return (with_scalars(g, nat).withColumn("late_vs_national", F.col("late_pct") - F.col("nat_late_pct"))
            .withColumn("low_volume", F.col("order_count") < low_volume))


def seller_delivery_all(order_sellers: DataFrame, master: DataFrame) -> DataFrame:
    """Per seller over its distinct delivered orders (orders outside del_valid
    count in order_count with null timing)."""
    dv = del_valid(master).select("order_id", "delivery_days", "delivery_delay_days", "is_late", "on_time",
                                  "review_score")
    # counted per seller and day number first: hash aggregation over all rows,
    # and the median reads one row per day number with its frequency
    days = order_sellers.join(dv, "order_id", "left").groupBy("seller_id", "delivery_days").agg(
        F.count("order_id").alias("n"), F.min("seller_state").alias("seller_state"), F.min("seller_city").alias("seller_city"),
        F.sum("delivery_delay_days").alias("delay"), F.count("delivery_delay_days").alias("delays"),
        F.sum("is_late").alias("late"), F.sum("on_time").alias("ontime"),
        F.sum("review_score").alias("score"), F.count("review_score").alias("scores"))
    dated = F.when(F.col("delivery_days").isNotNull(), F.col("n"))
    g = days.groupBy("seller_id").agg(
        F.sum("n").alias("order_count"),
        F.min("seller_state").alias("seller_state"),
        F.min("seller_city").alias("seller_city"),
        safe_div(F.sum(F.col("delivery_days") * F.col("n")), F.sum(dated)).alias("avg_delivery_days"),
        F.percentile("delivery_days", F.lit(0.5), F.col("n")).alias("median_delivery_days"),
        safe_div(F.sum("delay"), F.sum("delays")).alias("avg_delay_days"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("late_count"),
        F.coalesce(F.sum("ontime"), F.lit(0)).alias("on_time_count"),
        safe_div(F.sum("score"), F.sum("scores")).alias("avg_review_score"))
    return g.withColumn("late_pct", pct(F.col("late_count"), F.col("late_count") + F.col("on_time_count")))


def seller_delivery_qualified(order_sellers: DataFrame, master: DataFrame,
                              min_orders: int = MIN_SELLER_ORDERS) -> DataFrame:
    return seller_delivery_all(order_sellers, master).where(F.col("order_count") >= min_orders)


def seller_best_worst(qualified: DataFrame, top: int = 10) -> DataFrame:
    """Three top-k lists over qualified sellers: by volume, highest and lowest
    late share. Each is a bounded ``orderBy().limit()`` (top-k per task,
    then merge), never a global sort."""
    cols = ["seller_id", "order_count", "late_pct", "avg_delivery_days", "avg_review_score", "seller_state"]
    vol = qualified.orderBy(F.col("order_count").desc(), F.col("seller_id")).limit(top) \
        .select(*cols).withColumn("list", F.lit("top_volume"))
    worst = qualified.orderBy(F.col("late_pct").desc_nulls_last(), F.col("seller_id")).limit(top) \
        .select(*cols).withColumn("list", F.lit("worst_late"))
    best = qualified.orderBy(F.col("late_pct").asc_nulls_last(), F.col("seller_id")).limit(top) \
        .select(*cols).withColumn("list", F.lit("best_late"))
    return vol.unionByName(worst).unionByName(best)


def seller_delivery_by_state(order_sellers: DataFrame, master: DataFrame) -> DataFrame:
    """Per seller state: sellers, their orders, mean of seller late % and of
    seller review means (a mean of means, as in the analysed pipeline)."""
    s = seller_delivery_all(order_sellers, master)
    return s.where(F.col("seller_state").isNotNull()).groupBy("seller_state").agg(
        F.count("seller_id").alias("seller_count"),
        F.sum("order_count").alias("total_orders"),
        F.avg("late_pct").alias("avg_late_pct"),
        F.avg("avg_review_score").alias("avg_review_score"))


def _star_pct(k: int) -> F.Column:
    return (F.avg((F.col("review_score") == k).cast("int")) * 100).alias(f"pct_{k}star")


def review_by_delay_detailed(master: DataFrame) -> DataFrame:
    """Per non-empty delay bucket: orders, mean score, share of each star."""
    df = with_delay_bucket(del_valid(master).where(F.col("review_score").isNotNull()
                                                   & F.col("delivery_delay_days").isNotNull()))
    return df.groupBy("delay_bucket", "bucket_ord").agg(
        F.count("order_id").alias("order_count"), F.avg("review_score").alias("avg_review_score"),
        *[_star_pct(k) for k in range(1, 6)])


def review_by_state(master: DataFrame) -> DataFrame:
    df = del_valid(master).where(F.col("review_score").isNotNull())
    g = df.where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("review_score").alias("review_count"), F.avg("review_score").alias("avg_review_score"),
        _star_pct(1), _star_pct(5), (F.avg("is_late") * 100).alias("late_pct"))
    nat = df.agg(F.avg("review_score").alias("__nr"))
    return with_scalars(g, nat).withColumn("review_vs_national", F.col("avg_review_score") - F.col("__nr")).drop("__nr")


def review_by_category(first_cat: DataFrame, master: DataFrame, low_volume: int = 100) -> DataFrame:
    df = del_valid(master).where(F.col("review_score").isNotNull()) \
        .select("order_id", "review_score", "is_late", "delivery_delay_days")
    g = first_cat.select("order_id", "product_category_name_english").join(df, "order_id", "inner") \
        .where(F.col("product_category_name_english").isNotNull()).groupBy("product_category_name_english").agg(
            F.count("review_score").alias("review_count"), F.avg("review_score").alias("avg_review_score"),
            _star_pct(1), _star_pct(5), (F.avg("is_late") * 100).alias("late_pct"),
            F.avg("delivery_delay_days").alias("avg_delay_days"))
    nat = national(master).select(F.col("nat_review").alias("__nr"))
    return (with_scalars(g, nat).withColumn("review_vs_national", F.col("avg_review_score") - F.col("__nr"))
            .withColumn("low_volume", F.col("review_count") < low_volume).drop("__nr"))
