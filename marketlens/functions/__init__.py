"""Column-expression helpers. Everything here returns a ``Column`` so it stays
inside whole-stage code generation; nothing runs Python per row."""

from .dates import floor_days, hours_between, month_label, weekday_monday0
from .buckets import (DELAY_EDGES, DELAY_LABELS, SPEND_EDGES, SPEND_LABELS,
                      right_closed_bucket, bucket_dimension)
from .text import zero_pad, category_display, seller_display, late_severity
from .ratio import pct, safe_div

__all__ = [
    "floor_days", "hours_between", "month_label", "weekday_monday0",
    "DELAY_EDGES", "DELAY_LABELS", "SPEND_EDGES", "SPEND_LABELS",
    "right_closed_bucket", "bucket_dimension",
    "zero_pad", "category_display", "seller_display", "late_severity",
    "pct", "safe_div",
]
