"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from snapdeck.functions.calendar import (
    day_of_week_sunday,
    freshness_status,
    hours_between,
    is_month_end,
    is_month_start,
    seconds_between,
    status_band,
    week_sunday,
)
from snapdeck.functions.keys import surrogate_key
from snapdeck.functions.numeric import ratio_or_null, ratio_or_zero, safe_double
from snapdeck.functions.text import canonical_label, contains_any, split_pair, table_type_label, uri_parts

__all__ = [
    "canonical_label",
    "contains_any",
    "day_of_week_sunday",
    "freshness_status",
    "hours_between",
    "is_month_end",
    "is_month_start",
    "ratio_or_null",
    "ratio_or_zero",
    "safe_double",
    "seconds_between",
    "split_pair",
    "status_band",
    "surrogate_key",
    "table_type_label",
    "uri_parts",
    "week_sunday",
]
