"""Customer RFM table: recency, frequency, monetary value per person, their
quintile scores and the segment.

* R and M: quintile edges by linear interpolation, intervals ``(q_i, q_i+1]``
  with the lowest value included, so the score is 1 + the number of inner
  edges strictly below the value (R reversed). Recency is a day count
  (bounded domain: Spark's ``percentile``); monetary is money, so its edges
  come from the distributed exact quantile helper.
* F: quintile of the rank of frequency with ties broken by customer id (the
  order the people appear in); with r the 1-based rank among n customers the
  score is ``greatest(1, ceil(5 (r-1) / (n-1)))``. The rank is a distributed
  row number: no window over all customers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import floor_days
from .marts import delivered
from .stats import attach, exact_quantiles, range_row_number, with_scalars

QUINTILES = [0.2, 0.4, 0.6, 0.8]

# RFM segment labels, and in segment_of the score bounds of each.
CHAMPIONS, LOYAL, NEW = "Champions", "Loyal Customers", "New Customers"
POTENTIAL, AT_RISK, CANNOT_LOSE = "Potential Loyalists", "At Risk", "Cannot Lose Them"
LOST, NEEDS_ATTENTION = "Lost / Inactive", "Needs Attention"
SEGMENTS = [CHAMPIONS, LOYAL, NEW, POTENTIAL, AT_RISK, CANNOT_LOSE, LOST, NEEDS_ATTENTION]


def rfm_base(master: DataFrame) -> DataFrame:
    """Last purchase, delivered order count and spend per person, and the
    recency against (latest delivered purchase + 1 day)."""
    d = delivered(master)
    ref = d.agg(F.timestamp_add("DAY", F.lit(1), F.max("order_purchase_timestamp")).alias("__ref"))
    base = d.groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase_date"),
        F.count("order_id").alias("frequency"),
        F.coalesce(F.sum("order_value"), F.lit(0)).alias("monetary"))
    return with_scalars(base, ref).withColumn("recency_days", floor_days("__ref", "last_purchase_date")).drop("__ref")


def _edges_score(x: F.Column, edges: list[F.Column]) -> F.Column:
    s = F.lit(1)
    for e in edges:
        s = s + (e < x).cast("int")
    return s


def segment_of(r: F.Column, f: F.Column, m: F.Column) -> F.Column:
    """The ordered rule list; 'Cannot Lose Them' is unreachable because
    'At Risk' precedes it, kept for parity."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), CHAMPIONS)
             .when((r >= 3) & (f >= 3) & (m >= 3), LOYAL)
             .when((r >= 4) & (f <= 2), NEW)
             .when((r >= 3) & (f >= 2) & (m <= 2), POTENTIAL)
             .when((r <= 2) & (f >= 3) & (m >= 3), AT_RISK)
             .when((r <= 2) & (f >= 4) & (m >= 4), CANNOT_LOSE)
             .when((r <= 2) & (f <= 2) & (m <= 2), LOST)
             .otherwise(NEEDS_ATTENTION))


def customer_rfm(master: DataFrame) -> DataFrame:
    """The base is laid out once in the order of the frequency rank; the edges
    and the result read that layout."""
    base = range_row_number(rfm_base(master), [F.col("frequency").asc(), F.col("customer_unique_id").asc()], "__frank")
    r_edges = base.agg(F.percentile("recency_days", F.array(*[F.lit(p) for p in QUINTILES])).alias("__re"),
                       F.count(F.lit(1)).alias("__n"))
    m_edges = exact_quantiles(base, "monetary", {f"__me{i}": p for i, p in enumerate(QUINTILES)}).drop("n")
    stats = r_edges.transform(attach(m_edges))          # one row x one row
    s = with_scalars(base, stats)
    r_bin = _edges_score(F.col("recency_days"), [F.col("__re")[i] for i in range(4)])
    m_score = _edges_score(F.col("monetary"), [F.col(f"__me{i}") for i in range(4)])
    n = F.col("__n")
    f_score = F.when(n <= 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(F.lit(5.0) * (F.col("__frank") - 1) / (n - 1)).cast("int")))
    out = (s.withColumn("R_score", (6 - r_bin).cast("int"))
            .withColumn("F_score", f_score.cast("int"))
            .withColumn("M_score", m_score.cast("int")))
    out = out.withColumn("RFM_score", F.col("R_score") * 100 + F.col("F_score") * 10 + F.col("M_score")) \
             .withColumn("segment", segment_of(F.col("R_score"), F.col("F_score"), F.col("M_score")))
    return out.select("customer_unique_id", "last_purchase_date", "frequency", "monetary", "recency_days",
                      "R_score", "F_score", "M_score", "RFM_score", "segment")


def rfm_distribution(rfm: DataFrame) -> DataFrame:
    """Customers per segment, share, and how many of them are repeat buyers."""
    seg = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("customer_count"),
                                     F.count(F.when(F.col("frequency") > 1, 1)).alias("repeat_customers"))
    total = rfm.agg(F.count(F.lit(1)).alias("__t"))
    return with_scalars(seg, total).withColumn(
        "customer_pct", F.col("customer_count") / F.col("__t") * 100).drop("__t")
