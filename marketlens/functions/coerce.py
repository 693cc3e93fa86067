"""Text to typed columns; what does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, TimestampNTZType, TimestampType


def coerce(name: str, to: DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(to, StringType):
        return c
    if isinstance(to, (TimestampNTZType, TimestampType)):
        return F.try_to_timestamp(F.trim(c)).cast(to)
    if isinstance(to, IntegralType):  # whole numbers may be written with decimals
        n = F.trim(c).try_cast("double")
        return F.when(n == F.floor(n), n.try_cast(to))
    return F.trim(c).try_cast(to)
