"""Division without ANSI errors: a zero denominator gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    """num / den * 100, null when den is 0 or null."""
    return safe_div(num, den) * F.lit(100.0)
