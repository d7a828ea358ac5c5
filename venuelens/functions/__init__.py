"""Column expressions. Everything here is a built-in Spark expression (JVM side, codegen)."""

from .dates import as_timestamp, month_label, month_start, stamp_in_window, year_in_range
from .dayparts import DAY_PARTS, day_part
from .lists import split_trim
from .sampling import hash_keep, hash_threshold
from .stats import moments, pop_stddev_from_moments

__all__ = [
    "DAY_PARTS",
    "as_timestamp",
    "day_part",
    "hash_keep",
    "hash_threshold",
    "moments",
    "month_label",
    "month_start",
    "pop_stddev_from_moments",
    "split_trim",
    "stamp_in_window",
    "year_in_range",
]
