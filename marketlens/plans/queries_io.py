"""Registered queries: sources and sinks round-trips, individual cleaning and
scope steps, RFM building blocks. Writes go under the session's
``spark.checkpoint.dir`` (shared storage on a cluster), one fresh folder per call."""

from __future__ import annotations

from ..operators.stats import attach

import uuid

from pyspark.sql import functions as F

from ..operators import ml, quality, rfm as rf
from ..operators.marts import del_valid, delivered
from ..sources.processed import load_processed
from ..session import ensure_checkpoint_dir
from ..sources.manifest import read_table
from ..sources.readers import SOURCE_FILES, load_raw_csv
from ..sources.schemas import SOURCE_SCHEMAS
from ..sources.sinks import write_json, write_marts, write_model
from .queries_insights import evidence_ctes
from .queries_ml import ML_CTE
from .registry import REGISTRY, register
from .shared import mart


def _scratch(c, what: str) -> str:
    return f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/marketlens-io/{what}-{uuid.uuid4().hex}"


# Per table its columns, each with a kind (s text, n number, t time) and, where
# the oracle's fixture names it otherwise, that name.
RAW_COLUMNS = {
    "customers": "customer_id:s customer_unique_id:s customer_zip_code_prefix:s:zip_raw customer_city:s customer_state:s",
    "orders": "order_id:s customer_id:s order_status:s order_purchase_timestamp:t order_approved_at:t "
              "order_delivered_customer_date:t order_estimated_delivery_date:t",
    "items": "order_id:s order_item_id:n product_id:s seller_id:s price:n freight_value:n",
    "payments": "order_id:s payment_sequential:n payment_type:s payment_installments:n payment_value:n",
    "reviews": "review_id:s order_id:s review_score:n review_comment_message:s review_creation_date:t",
    "products": "product_id:s product_category_name:s product_weight_g:n product_length_cm:n "
                "product_height_cm:n product_width_cm:n",
    "sellers": "seller_id:s seller_city:s seller_state:s",
    "geolocation": "geolocation_zip_code_prefix:s:zip_raw geolocation_lat:n:lat geolocation_lng:n:lng "
                   "geolocation_city:s:city geolocation_state:s:state",
    "translation": "product_category_name:s product_category_name_english:s",
}


def _raw_columns(table: str):
    for part in RAW_COLUMNS[table].split():
        name, kind, *other = part.split(":")
        yield name, kind, (other or [name])[0]


TITLE_SQL = """CASE WHEN review_id % 3 = 0 THEN concat('No. ', review_id, ',' || chr(10) || '"order" ', order_id, chr(10) || chr(10) || 'end') END"""


def _title():
    """Review titles of the written files: line breaks, quotes and delimiters, from the data."""
    return F.when(F.col("review_id") % 3 == 0, F.concat(F.lit("No. "), F.col("review_id"), F.lit(',\n"order" '), F.col("order_id"), F.lit("\n\nend")))


def _write_csv(c) -> str:
    """The nine source tables as headed CSV in the source layout; their folder."""
    base = _scratch(c, "raw-csv")
    for name, fname in SOURCE_FILES.items():
        df = c.raw[name]
        if name == "reviews":
            df = df.withColumn("review_comment_title", _title())
        cols = [F.col(f.name).cast("string").alias(f.name) if f.name in df.columns
                else F.lit(None).cast("string").alias(f.name) for f in SOURCE_SCHEMAS[name].fields]
        df.select(*cols).write.mode("overwrite").option("header", True) \
            .option("escape", '"').csv(f"{base}/{fname}")
    return base


def _csv_roundtrip(c):
    """The source tables written and read back through the coercing CSV reader;
    per column the rows, the nulls and a total (numbers summed, texts by length,
    times by millions of epoch seconds)."""
    base = _write_csv(c)
    parts = []
    for name, df in load_raw_csv(c.spark, base).items():
        measure = {"s": F.length, "n": lambda x: x, "t": lambda x: F.unix_seconds(x.cast("timestamp")) / 1e6}
        stats = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*[
            F.struct(F.lit(col).alias("column"), F.count_if(F.col(col).isNull()).alias("nulls"),
                     F.sum(measure[kind](F.col(col))).cast("double").alias("total"))
            for col, kind, _ in _raw_columns(name)]).alias("cols"))
        parts.append(stats.select(F.lit(name).alias("table"), "rows", F.explode("cols").alias("x"))
                     .select("table", "x.column", F.col("rows").alias("row_count"), "x.nulls", "x.total"))
    return quality.union_all(parts)


def _raw_sql() -> str:
    measure = {"s": "sum(length(CAST({0} AS VARCHAR)))", "n": "sum({0})", "t": "sum(floor(epoch_us({0}) / 1e6) / 1e6)"}
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{col}' AS "column", count(*) AS row_count, count(*) - count({fx}) AS nulls,
                   CAST({measure[kind].format(fx)} AS DOUBLE) AS total FROM fx_{t}"""
        for t in RAW_COLUMNS for col, kind, fx in _raw_columns(t))


register("load_raw_tables", "table:s, column:s, row_count:i, nulls:i, total:d", _raw_sql())(_csv_roundtrip)


def _csv_rows(c):
    """Every row read back, as one text: cells joined, numbers in millionths,
    times in epoch seconds, ~ for null."""
    cell = {"s": lambda x: x, "n": lambda x: F.round(x.cast("double") * 1e6).cast("long").cast("string"),
            "t": lambda x: F.unix_seconds(x.cast("timestamp")).cast("string")}
    parts = []
    for name, df in load_raw_csv(c.spark, _write_csv(c)).items():
        cells = [cell[kind](F.col(col)) for col, kind, _ in _row_columns(name)]
        parts.append(df.select(F.lit(name).alias("table"), F.concat_ws("|", *[F.coalesce(x, F.lit("~")) for x in cells]).alias("row")))
    return quality.union_all(parts)


def _row_columns(table: str):
    yield from _raw_columns(table)
    if table == "reviews":
        yield "review_comment_title", "s", TITLE_SQL


def _rows_sql() -> str:
    cell = {"s": "CAST({0} AS VARCHAR)", "n": "CAST(CAST(round(CAST({0} AS DOUBLE) * 1e6) AS BIGINT) AS VARCHAR)",
            "t": "CAST(CAST(floor(epoch_us({0}) / 1e6) AS BIGINT) AS VARCHAR)"}
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", concat_ws('|', {', '.join(f"coalesce({cell[kind].format(fx)}, '~')" for _, kind, fx in _row_columns(t))}) AS "row"
            FROM fx_{t}""" for t in RAW_COLUMNS)


register("load_raw_rows", "table:s, row:s", _rows_sql())(_csv_rows)


def _marts_roundtrip(c):
    path = _scratch(c, "marts")
    df = mart(c, "monthly")
    write_marts({"monthly_trends": df}, path, partition_by={"monthly_trends": "ym"})
    return read_table(c.spark, path, "monthly_trends", df.schema)


register("write_marts", REGISTRY["monthly_trends"].spec, REGISTRY["monthly_trends"].sql,
         REGISTRY["monthly_trends"].extra_ctes)(_marts_roundtrip)


# marts written and read back: mart -> the oracle's table
WRITTEN = {"kpis": "ev_kpis", "monthly": "monthly", "cat_perf": "ev_cat", "seller_perf": "ev_seller", "rfm_seg": "ev_seg",
           "repeat": "ev_repeat", "cust_geo": "ev_geo", "del_ov": "ev_ov", "buckets": "ev_buckets", "del_time": "ev_deltime",
           "del_state": "state_enriched", "del_cat": "cat_enriched", "seller_del": "ev_sellerq", "rev_delay": "ev_rdelay",
           "rev_state": "ev_rstate", "rev_cat": "ev_rcat", "spend_stats": "ev_spend"}


def _all_marts_roundtrip(c):
    """Per mart the rows read back, and the rows that the write changed."""
    path = _scratch(c, "marts-all")
    own = {name: mart(c, name) for name in WRITTEN}
    write_marts(own, path)
    parts = []
    for name, df in own.items():
        back = read_table(c.spark, path, name, df.schema)
        differ = df.exceptAll(back).unionByName(back.exceptAll(df)).agg(F.count(F.lit(1)).alias("differing"))
        parts.append(back.agg(F.count(F.lit(1)).alias("rows")).transform(attach(differ)).select(F.lit(name).alias("mart"), "rows", "differing"))
    return quality.union_all(parts)


register("write_marts_all", "mart:s, rows:i, differing:i",
         " UNION ALL ".join(f"SELECT '{m}' AS mart, count(*) AS rows, 0 AS differing FROM {t}" for m, t in WRITTEN.items()),
         evidence_ctes())(_all_marts_roundtrip)


#: Months of the processed scope that the query loads.
LOAD_MONTHS = ("1996-03", "1996-09")


def _load_processed(c):
    """The order fact written by month, one half of its months written again
    later, and the delivered orders of some months read through the manifest."""
    path, month = _scratch(c, "processed"), "purchase_month_label"
    write_marts({"orders_master": c.master}, path, partition_by={"orders_master": month})
    later = c.master.where(F.col("purchase_month") % 2 == 0)
    write_marts({"orders_master": later}, path, partition_by={"orders_master": month}, replace_parts=True)
    return load_processed(c.spark, path, c.master.schema, *LOAD_MONTHS)


register("load_processed", "order_id:i, purchase_month_label:s, order_purchase_timestamp:t, order_value:d, is_late:i, delivery_days:i",
         f"""SELECT order_id, purchase_month_label, order_purchase_timestamp, order_value, is_late, delivery_days
             FROM delivered WHERE purchase_month_label BETWEEN '{LOAD_MONTHS[0]}' AND '{LOAD_MONTHS[1]}'""")(_load_processed)


def _json_roundtrip(c):
    path = _scratch(c, "kpis-json")
    write_json(mart(c, "kpis"), path)
    return c.spark.read.json(path)


register("write_kpi_json", REGISTRY["topline_kpis"].spec, REGISTRY["topline_kpis"].sql)(_json_roundtrip)


def _model_roundtrip(c):
    """Save the fitted forest pipeline, load it back, and score the test set
    with both: the predictions must agree row for row."""
    from pyspark.ml import PipelineModel
    tm = c.models
    path = _scratch(c, "model")
    write_model(tm.rf, path)
    loaded = PipelineModel.load(path)
    a = tm.rf.transform(tm.test).select("order_id", F.col("prediction").alias("p1"))
    b = loaded.transform(tm.test).select("order_id", F.col("prediction").alias("p2"))
    return a.join(b, "order_id").agg(F.count(F.lit(1)).alias("scored"),
                                     F.count_if(F.col("p1") != F.col("p2")).alias("mismatches"))


register("write_model_artifacts", "scored:i, mismatches:i", "SELECT count(*) AS scored, 0 AS mismatches FROM ml_test", ML_CTE)(_model_roundtrip)

register("clean_orders",
         "order_id:i, customer_id:i, order_status:s, order_purchase_timestamp:t, order_approved_at:t, "
         "order_delivered_customer_date:t, order_estimated_delivery_date:t",
         "SELECT * FROM fx_orders")(lambda c: c.orders)
register("clean_items", "order_id:i, order_item_id:i, product_id:i, seller_id:i, price:d, freight_value:d",
         "SELECT * FROM fx_items")(lambda c: c.items)
register("clean_sellers", "seller_id:i, seller_city:s, seller_state:s", "SELECT * FROM fx_sellers")(
    lambda c: c.sellers)

register("scope_delivered", "order_id:i, is_late:i", "SELECT order_id, is_late FROM delivered")(
    lambda c: delivered(c.master).select("order_id", "is_late"))
register("scope_del_valid", "order_id:i, is_late:i, delivery_delay_days:i",
         "SELECT order_id, is_late, delivery_delay_days FROM del_valid")(
    lambda c: del_valid(c.master).select("order_id", "is_late", "delivery_delay_days"))

from .queries_customers import RFM_CTE  # noqa: E402

register("rfm_base", "customer_unique_id:i, last_purchase_date:t, frequency:i, monetary:d, recency_days:i",
         "SELECT * FROM rfm_r", RFM_CTE)(lambda c: rf.rfm_base(c.master))


def _edges(c):
    from ..operators.stats import exact_quantiles
    base = rf.rfm_base(c.master)
    r = base.agg(*[F.percentile("recency_days", F.lit(p)).alias(f"r{int(p * 100)}") for p in rf.QUINTILES])
    m = exact_quantiles(base, "monetary", {f"m{int(p * 100)}": p for p in rf.QUINTILES}).drop("n")
    return r.transform(attach(m))


register("rfm_quintile_edges", "r20:d, r40:d, r60:d, r80:d, m20:d, m40:d, m60:d, m80:d",
         """SELECT re[1] AS r20, re[2] AS r40, re[3] AS r60, re[4] AS r80,
                   me[1] AS m20, me[2] AS m40, me[3] AS m60, me[4] AS m80 FROM rfm_edges""", RFM_CTE)(_edges)

register("rfm_scores", "customer_unique_id:i, R_score:i, F_score:i, M_score:i, RFM_score:i",
         "SELECT customer_unique_id, R_score, F_score, M_score, RFM_score FROM rfm", RFM_CTE)(
    lambda c: c.rfm.select("customer_unique_id", "R_score", "F_score", "M_score", "RFM_score"))

register("band_lift", "base_late_pct:d, high_late_pct:d, lift:d")(lambda c: ml.band_lift(c.models.rf_scored))
register("check_band_monotonic", "violations:i, passed:b")(
    lambda c: ml.check_band_monotonic(ml.risk_bands(c.models.rf_scored)))
