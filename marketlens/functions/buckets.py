"""Right-closed interval buckets ``(a, b]`` with an ordinal, and the bucket
dimension used to emit empty buckets with zero counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Delivery-delay bucket edges (days, right-closed, open-ended at
# both ends) and labels, earliest to latest.
DELAY_EDGES = [-math.inf, -7, -3, 0, 3, 7, 14, math.inf]
DELAY_LABELS = ["Early >7d", "Early 3-7d", "Early 0-3d",
                "Late 1-3d", "Late 4-7d", "Late 8-14d", "Late >14d"]

# Customer spend bucket edges (currency units, right-closed) and labels.
# The top bucket is open: its label has no upper bound.
SPEND_EDGES = [0, 50, 100, 200, 300, 500, 1000, 2000, math.inf]
SPEND_LABELS = ["R$0-50", "R$51-100", "R$101-200", "R$201-300",
                "R$301-500", "R$501-1000", "R$1001-2000", "R$2000+"]


def right_closed_bucket(x: Column, edges, labels, ordinal: bool = False) -> Column:
    """Label (or 1-based ordinal) of the interval ``(edges[i], edges[i+1]]``
    holding ``x``; null when ``x`` is null or outside ``(edges[0], edges[-1]]``."""
    assert len(edges) == len(labels) + 1
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = F.lit(True)
        if not (isinstance(lo, float) and math.isinf(lo)):
            cond = cond & (x > F.lit(lo))
        if not (isinstance(hi, float) and math.isinf(hi)):
            cond = cond & (x <= F.lit(hi))
        val = F.lit(i + 1) if ordinal else F.lit(lab)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def bucket_dimension(spark: SparkSession, labels, name: str = "bucket") -> DataFrame:
    """Small dimension (label, ordinal) for left-joining counts onto every bucket."""
    rows = [(lab, i + 1) for i, lab in enumerate(labels)]
    return spark.createDataFrame(rows, f"{name} string, bucket_ord int")
