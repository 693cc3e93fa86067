"""Date arithmetic with the semantics of the analysed pipeline.

Day differences floor towards minus infinity (an order delivered 5 hours
before its estimate is -1 day, 5 hours after is 0 days); calendar-day
functions (``datediff``) and truncating casts give different answers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000.0
_MICROS_PER_HOUR = 3_600_000_000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def floor_days(end, start) -> Column:
    """floor((end - start) / 24h) as BIGINT; null if either side is null."""
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(micros / F.lit(_MICROS_PER_DAY)).cast("bigint")


def hours_between(end, start) -> Column:
    """(end - start) in fractional hours."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(_MICROS_PER_HOUR)


def month_label(ts) -> Column:
    """'yyyy-MM' label of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM")


def weekday_monday0(ts) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))
