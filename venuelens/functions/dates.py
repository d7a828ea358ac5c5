"""Date predicates and conversions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_in_range(c: Column | str, year_min: int, year_max: int) -> Column:
    """True when the first four characters of a text stamp are digits within [min, max].

    NULL, empty, short or non-digit text gives false (never NULL), so it can be used in
    ``filter`` and in array ``filter`` alike.
    """
    head = F.substring(_col(c), 1, 4)
    ok = head.rlike("^[0-9]{4}$") & head.try_cast("int").between(year_min, year_max)
    return F.coalesce(ok, F.lit(False))


def stamp_in_window(c: Column | str, start: str, end: str) -> Column:
    """True when a text stamp parses as a timestamp in the half-open window [start, end)."""
    ts = _col(c).try_cast("timestamp_ntz")
    ok = (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))
    return F.coalesce(ok, F.lit(False))


def year_bounds(year_min: int, year_max: int) -> tuple[Column, Column]:
    """Half-open ``timestamp_ntz`` literals covering whole years, foldable for scan pushdown."""
    lo = F.lit(dt.datetime(year_min, 1, 1).isoformat(sep=" ")).cast("timestamp_ntz")
    hi = F.lit(dt.datetime(year_max + 1, 1, 1).isoformat(sep=" ")).cast("timestamp_ntz")
    return lo, hi


def as_timestamp(df: DataFrame, column: str) -> Column:
    """The column as ``timestamp_ntz``: used as is when already temporal, else parsed (NULL on failure)."""
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    return c.try_cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    """First instant of the month, kept as ``timestamp_ntz`` (``date_trunc`` alone widens the type)."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def month_label(ts: Column) -> Column:
    """``yyyy-MM`` text of a timestamp."""
    return F.date_format(ts, "yyyy-MM")
