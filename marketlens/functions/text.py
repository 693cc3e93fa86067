"""String helpers: zip padding, display labels, severity bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(x: Column, width: int = 5) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole
    (``lpad`` alone would truncate '123456' to '12345')."""
    s = x.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def category_display(raw: Column, overrides: dict | None = None) -> Column:
    """Override map first, else underscores to spaces in title case."""
    # upper-case the first letter of each word, keep the rest as is
    words = F.split(F.regexp_replace(raw, "_", " "), " ")
    default = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                                 F.substring(w, 2, 1 << 20))), " ")
    if not overrides:
        return default
    m = F.create_map(*[F.lit(v) for kv in overrides.items() for v in kv])
    return F.coalesce(m[raw], default)


def seller_display(seller_id: Column, keep: int = 8) -> Column:
    """'...' followed by the last ``keep`` characters of the id."""
    s = seller_id.cast("string")
    return F.concat(F.lit("..."), F.substring(s, -keep, keep))


def late_severity(late_pct: Column, national_pct: Column,
                  high: float = 15.0, medium: float = 10.0) -> Column:
    """Colour band of a late-delivery percentage: high / medium / above
    national / normal."""
    return (F.when(late_pct > F.lit(high), "high")
             .when(late_pct > F.lit(medium), "medium")
             .when(late_pct > national_pct, "above_national")
             .otherwise("normal"))
