"""Curation building blocks: column trimming, year windows, packed-stamp filtering,
key-hash sampling, referential (semi-join) filtering and visit expansion.

All of them are row-local or a single join, so a whole curation composes into one lazy plan
per output and is written once: no intermediate file is rewritten in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import year_bounds, year_in_range
from ..functions.sampling import hash_keep

# Characters stripped around each packed stamp - every Unicode whitespace character
# (tab, line feed, vertical tab, form feed, carriage return, the four information separators,
# space, next line, no-break space, ogham space, the en quad .. hair space range, line and
# paragraph separators, narrow no-break space, medium mathematical space, ideographic space).
STAMP_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def trim_columns(
    df: DataFrame, drop: Iterable[str] = (), drop_prefix: str = "", carried: str | None = None
) -> DataFrame:
    """Drop columns by exact name and by prefix; names that are not present are ignored.

    ``carried`` names a map column of further fields: the same names go from its keys (a map left
    empty becomes NULL). It is ignored when the frame has no such column.
    """
    names = set(drop)
    keep = [
        c for c in df.columns if c not in names and not (drop_prefix and c.startswith(drop_prefix))
    ]
    out = df.select(*[_q(c) for c in keep])
    if carried is None or carried not in keep or not (names or drop_prefix):
        return out

    def stays(key: Column, _: Column) -> Column:
        listed = key.isin(sorted(names)) if names else F.lit(False)
        return ~(listed | key.startswith(drop_prefix)) if drop_prefix else ~listed

    left = F.map_filter(_q(carried), stays)
    return out.withColumn(carried, F.when(F.size(left) > 0, left))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


YEAR, MONTH = "layer_year", "layer_month"


def with_periods(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the year and month of a date column (temporal, or text that begins ``yyyy-MM``) as
    ``layer_year`` and ``layer_month``, for a layer partitioned by them; NULL where there is none."""
    stamp = _q(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        year, month = F.substring(stamp, 1, 4).try_cast("int"), F.substring(stamp, 6, 2).try_cast("int")
    else:
        year, month = F.year(stamp), F.month(stamp)
    return df.withColumns({YEAR: year, MONTH: month})


def year_window(df: DataFrame, column: str, year_min: int, year_max: int) -> DataFrame:
    """Keep rows whose date falls in the inclusive year range.

    A layer partitioned by :func:`with_periods` is cut to the folders of these years first.

    A temporal column gets a half-open range on the value itself so the predicate reaches the
    parquet scan (``PushedFilters``) and partition pruning; a text column gets the text-prefix
    predicate (first four characters are digits within the range).
    """
    dtype = df.schema[column].dataType
    if YEAR in df.columns:
        df = df.filter(F.col(YEAR).between(year_min, year_max))
    if isinstance(dtype, T.DateType):
        # date literals keep the predicate on the bare column, so it is pushed to the scan
        lo, hi = F.lit(dt.date(year_min, 1, 1)), F.lit(dt.date(year_max + 1, 1, 1))
        return df.filter((_q(column) >= lo) & (_q(column) < hi))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        lo, hi = year_bounds(year_min, year_max)
        return df.filter((_q(column) >= lo) & (_q(column) < hi))
    return df.filter(year_in_range(_q(column), year_min, year_max))


def packed_filter(
    df: DataFrame,
    column: str,
    year_min: int = 2018,
    year_max: int = 2021,
    keep: Callable[[Column], Column] | None = None,
    sep_out: str = ", ",
) -> DataFrame:
    """Filter the stamps packed in one text column.

    Split on ``","``, strip whitespace from each stamp, keep those passing ``keep`` (default: the
    year-prefix predicate), join the survivors with ``sep_out``; a record left with no stamp
    (or with a NULL column) is dropped. Row-local: no shuffle.
    """
    pred = keep or (lambda s: year_in_range(s, year_min, year_max))
    stamps = F.filter(
        F.transform(F.split(_q(column), ","), lambda s: F.btrim(s, F.lit(STAMP_WHITESPACE))),
        pred,
    )
    tmp = free_name(df, "kept_stamps")
    out = df.withColumn(tmp, stamps).filter(F.coalesce(F.size(tmp) > 0, F.lit(False)))
    return out.withColumn(column, F.array_join(tmp, sep_out)).drop(tmp)


def sample_entities(
    df: DataFrame, key: str, fraction: float, salt: int | str = 42, method: str = "md5"
) -> DataFrame:
    """Reproducible Bernoulli sample of entities by key hash (same rows for any partitioning)."""
    return df.filter(hash_keep(_q(key), fraction, salt, method))


def sample_facts(
    df: DataFrame, key: str, fraction: float, salt: int | str = 42, method: str = "md5"
) -> DataFrame:
    """Reproducible Bernoulli sample of facts, keyed on the fact id with its own salt."""
    return df.filter(hash_keep(_q(key), fraction, salt, method))


def cascade_semi(
    facts: DataFrame,
    keys: DataFrame,
    fact_key: str,
    key: str | None = None,
    prefilter: Column | None = None,
) -> DataFrame:
    """Referential filter: keep facts whose key is present in ``keys`` (left semi join).

    A NULL fact key never matches. ``prefilter`` is a row-local predicate known to hold for every
    kept fact (for a hash-sampled key set: the same hash predicate on the fact key); applying it
    first shrinks the join input before any shuffle. The join strategy (broadcast when the key
    side is measured small at runtime, sort-merge with skew splitting otherwise) is left to AQE:
    the key side is data-sized, so it is never broadcast unconditionally.
    """
    key = key or fact_key
    if prefilter is not None:
        facts = facts.filter(prefilter)
    right = keys.select(_q(key).alias("__k")).filter(F.col("__k").isNotNull())
    return facts.join(right, _q(fact_key) == F.col("__k"), "left_semi")


def pack_stamps(
    df: DataFrame,
    key: str,
    ts: str,
    out: str = "date",
    *,
    block_col: str,
    block_size: int = 256,
    fmt: str = "yyyy-MM-dd HH:mm:ss",
) -> DataFrame:
    """Pack stamps into one text per (key, block): sorted, formatted, joined with ``", "``.

    Used to build the packed visit layout from long-form rows. ``block_col`` (a monotone id,
    e.g. an event id) caps each packed record at ``block_size`` stamps, so no group is
    unbounded even for a key holding a large share of all rows.
    """
    group = [_q(key), F.floor(_q(block_col) / F.lit(block_size)).alias("block")]
    return df.groupBy(*group).agg(
        F.array_join(F.array_sort(F.collect_list(F.date_format(_q(ts), fmt))), ", ").alias(out)
    )


def expand_visits(
    df: DataFrame, key: str = "business_id", column: str = "date", out: str = "checkin_ts"
) -> DataFrame:
    """Packed visit text -> one row per stamp ``(key, timestamp_ntz)``.

    Split as :func:`packed_filter` does, on ``","`` with white space stripped from each stamp; a stamp
    that does not parse becomes NULL; a NULL or missing text yields no row.
    """
    exploded = df.select(_q(key), F.explode(F.split(_q(column), ",")).alias("__s"))
    return exploded.select(_q(key), F.btrim("__s", F.lit(STAMP_WHITESPACE)).try_cast("timestamp_ntz").alias(out))
