"""Customer marts over the RFM table: segment and repeat summaries,
geography, spend distribution and concentration, per-customer detail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import SPEND_EDGES, SPEND_LABELS, bucket_dimension, pct, right_closed_bucket, safe_div
from .marts import delivered
from .stats import exact_quantiles, top_k_sum, with_scalars, attach

REPEAT, ONE_TIME = "Repeat", "One-Time"


def customer_type(freq: F.Column) -> F.Column:
    return F.when(freq >= 2, REPEAT).otherwise(ONE_TIME)


def _mean(c: str) -> F.Column:
    """Mean as exact sum / count (money stays decimal until the division)."""
    return safe_div(F.sum(c), F.count(c))


def _shares(df: DataFrame, count_col: str, rev_col: str) -> DataFrame:
    tot = df.agg(F.sum(count_col).alias("__tc"), F.sum(rev_col).alias("__tr"))
    return (with_scalars(df, tot)
            .withColumn("customer_pct", pct(F.col(count_col), F.col("__tc")))
            .withColumn("revenue_pct", pct(F.col(rev_col), F.col("__tr")))
            .drop("__tc", "__tr"))


def rfm_segment_summary(rfm: DataFrame) -> DataFrame:
    seg = rfm.groupBy("segment").agg(
        F.count("customer_unique_id").alias("customer_count"),
        F.sum("monetary").alias("total_revenue"),
        _mean("monetary").alias("avg_spend"),
        F.avg("recency_days").alias("avg_recency_days"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("R_score").alias("avg_r_score"),
        F.avg("F_score").alias("avg_f_score"),
        F.avg("M_score").alias("avg_m_score"))
    med = exact_quantiles(rfm, "monetary", {"median_spend": 0.5}, keys=["segment"]).select("segment", "median_spend")
    return _shares(seg.join(med, "segment", "left"), "customer_count", "total_revenue")


def repeat_vs_onetime(rfm: DataFrame, master: DataFrame) -> DataFrame:
    """One-time (1 delivered order) vs repeat customers; average order value
    per type from the delivered orders of those customers."""
    typed = rfm.withColumn("customer_type", customer_type(F.col("frequency")))
    summ = typed.groupBy("customer_type").agg(
        F.count("customer_unique_id").alias("customer_count"),
        F.sum("monetary").alias("total_revenue"),
        _mean("monetary").alias("avg_spend"),
        F.avg("frequency").alias("avg_order_count"),
        F.max("frequency").alias("max_order_count"))
    med = exact_quantiles(typed, "monetary", {"median_spend": 0.5}, keys=["customer_type"]) \
        .select("customer_type", "median_spend")
    aov = (delivered(master).select("customer_unique_id", "order_value")
           .join(typed.select("customer_unique_id", "customer_type"), "customer_unique_id", "inner")
           .groupBy("customer_type").agg(_mean("order_value").alias("avg_order_value")))
    return _shares(summ.join(med, "customer_type", "left").join(aov, "customer_type", "left"),
                   "customer_count", "total_revenue")


def repeat_frequency_dist(rfm: DataFrame, top: int = 10) -> DataFrame:
    """Customers per order count among repeat customers, smallest counts first."""
    return (rfm.where(F.col("frequency") >= 2).groupBy(F.col("frequency").alias("order_count"))
               .agg(F.count(F.lit(1)).alias("customer_count"))
               .orderBy("order_count").limit(top))


def customer_home(master: DataFrame) -> DataFrame:
    """State and city of each person's earliest delivered order (ties by order id)."""
    return (delivered(master).groupBy("customer_unique_id").agg(
                F.min_by(F.struct("customer_state", "customer_city"),
                         F.struct("order_purchase_timestamp", "order_id")).alias("h"))
            .select("customer_unique_id", F.col("h.customer_state").alias("customer_state"),
                    F.col("h.customer_city").alias("customer_city")))


def customer_geography(master: DataFrame, rfm: DataFrame) -> DataFrame:
    d = delivered(master)
    st = d.where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("order_id").alias("order_count"),
        F.count_distinct("customer_unique_id").alias("customer_uid_count"),
        F.coalesce(F.sum("order_value"), F.lit(0)).alias("total_revenue"),
        _mean("order_value").alias("avg_order_value"),
        F.avg("review_score").alias("avg_review_score"))
    tot = st.agg(F.sum("customer_uid_count").alias("__tu"), F.sum("total_revenue").alias("__tr"))
    st = (with_scalars(st, tot)
          .withColumn("customer_pct", pct(F.col("customer_uid_count"), F.col("__tu")))
          .withColumn("revenue_pct", pct(F.col("total_revenue"), F.col("__tr"))).drop("__tu", "__tr"))
    rep = (rfm.where(F.col("frequency") >= 2).select("customer_unique_id")
              .join(customer_home(master), "customer_unique_id", "left")
              .where(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(F.count(F.lit(1)).alias("repeat_customer_count")))
    st = st.join(rep, "customer_state", "left") \
           .withColumn("repeat_customer_count", F.coalesce(F.col("repeat_customer_count"), F.lit(0)))
    return st.withColumn("repeat_rate_pct", pct(F.col("repeat_customer_count"), F.col("customer_uid_count")))


def state_overcount(master: DataFrame) -> DataFrame:
    """People counted in more than one state: Σ per-state distinct people −
    distinct people. The per-state count is pre-deduplicated on (state, person)."""
    d = delivered(master)
    pairs = d.select("customer_state", "customer_unique_id").distinct()
    return pairs.agg(F.count(F.lit(1)).alias("state_sum")).transform(attach(
        d.agg(F.count_distinct("customer_unique_id").alias("distinct_customers")))) \
        .withColumn("overcount", F.col("state_sum") - F.col("distinct_customers"))


SPEND_PROBS = {"median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def spend_statistics(rfm: DataFrame) -> DataFrame:
    q = exact_quantiles(rfm, "monetary", SPEND_PROBS)
    m = rfm.agg(F.min("monetary").alias("min"), _mean("monetary").alias("mean"), F.max("monetary").alias("max"))
    return q.transform(attach(m)).select("n", "min", "median", "mean", "p75", "p90", "p95", "p99", "max")


def customer_spending_dist(spark: SparkSession, rfm: DataFrame, edges=None, labels=None) -> DataFrame:
    """People per spend bucket ``(a, b]``; every bucket present. Shares are of
    all people / all spend (zero spend falls in no bucket but counts in the base)."""
    edges = SPEND_EDGES if edges is None else edges
    labels = SPEND_LABELS if labels is None else labels
    b = rfm.withColumn("spend_bucket", right_closed_bucket(F.col("monetary"), edges, labels))
    counts = b.where(F.col("spend_bucket").isNotNull()).groupBy("spend_bucket").agg(
        F.count("customer_unique_id").alias("customer_count"), F.sum("monetary").alias("total_revenue"),
        _mean("monetary").alias("avg_spend"))
    out = F.broadcast(bucket_dimension(spark, labels, "spend_bucket")).join(counts, "spend_bucket", "left") \
        .withColumn("customer_count", F.coalesce(F.col("customer_count"), F.lit(0))) \
        .withColumn("total_revenue", F.coalesce(F.col("total_revenue"), F.lit(0)))
    tot = rfm.agg(F.count(F.lit(1)).alias("__tc"), F.sum("monetary").alias("__tr"))
    return (with_scalars(out, tot)
            .withColumn("customer_pct", pct(F.col("customer_count"), F.col("__tc")))
            .withColumn("revenue_pct", pct(F.col("total_revenue"), F.col("__tr"))).drop("__tc", "__tr"))


def high_value_customers(rfm: DataFrame, p: float = 0.9) -> DataFrame:
    """People spending at least the p-quantile: count, spend and share."""
    thr = exact_quantiles(rfm, "monetary", {"threshold": p}).select("threshold")
    s = with_scalars(rfm, thr)
    hv = F.col("monetary") >= F.col("threshold")
    return s.groupBy("threshold").agg(
        F.count(F.when(hv, 1)).alias("customer_count"),
        F.coalesce(F.sum(F.when(hv, F.col("monetary"))), F.lit(0)).alias("total_revenue"),
        F.sum("monetary").alias("__all")) \
        .withColumn("revenue_pct", pct(F.col("total_revenue"), F.col("__all"))).drop("__all")


def segment_spend_profile(rfm: DataFrame) -> DataFrame:
    g = rfm.groupBy("segment").agg(_mean("monetary").alias("avg_spend"), F.sum("monetary").alias("total_rev"))
    q = exact_quantiles(rfm, "monetary", {"median_spend": 0.5, "p90_spend": 0.9}, keys=["segment"]) \
        .select("segment", "median_spend", "p90_spend")
    return g.join(q, "segment", "left")


def customer_segment_detail(rfm: DataFrame, master: DataFrame) -> DataFrame:
    return (rfm.withColumn("customer_type", customer_type(F.col("frequency")))
               .join(customer_home(master), "customer_unique_id", "left"))


def top_decile_share(rfm: DataFrame, share: float = 0.1) -> DataFrame:
    """Revenue share of the floor(share * n) biggest spenders (exact with ties)."""
    top = top_k_sum(rfm, "monetary", lambda n: F.floor(n * F.lit(share)))
    tot = rfm.agg(F.sum("monetary").alias("total_monetary"))
    return top.transform(attach(tot)).withColumn("top_share_pct", pct(F.col("top_sum"), F.col("total_monetary")))
