"""Mergeable moments: aggregate facts once per key, combine the partial results later.

``count(*)`` and ``count(x)`` are kept apart because NULL measures count in the first only. The
second moment is kept centred (the sum of squared distances from the part's own mean), so that a
deviation is not the small difference of two large sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def centred_second_moment(x: str) -> Column:
    """Sum of squared distances of ``x`` from its mean, as an aggregate; NULL without a value."""
    return F.var_pop(x) * F.count(x)


def moments(x: str, prefix: str = "_") -> list[Column]:
    """Partial aggregates of ``x``: rows, non-NULL count, sum and centred second moment."""
    return [
        F.count(F.lit(1)).alias(f"{prefix}rows"),
        F.count(x).alias(f"{prefix}n"),
        F.sum(x).alias(f"{prefix}s"),
        centred_second_moment(x).alias(f"{prefix}m2"),
    ]


def merge_moments(
    parts: DataFrame, keys: Sequence[str], prefix: str = "_", having: Column | None = None, few_parts: bool = False
) -> DataFrame:
    """Combine the partial moments in ``parts`` to one row per key (``having`` filters on the sums).

    Each part adds its own second moment and its size times the squared distance of its mean from the
    mean of all, less what that mean's rounding adds: the pairwise formula for all parts of a key at
    once. The totals of a key, which give its mean, are aggregated first and joined back; where a key
    is known to have ``few_parts``, a window takes the place of the join.
    """
    rows, n, s, m2 = (F.col(f"{prefix}{c}") for c in ("rows", "n", "s", "m2"))
    k = list(keys)
    if few_parts:
        w = Window.partitionBy(*k)
        every = parts.withColumns({"__rows": F.sum(rows).over(w), "__n": F.sum(n).over(w), "__s": F.sum(s).over(w)})
    else:
        totals = parts.groupBy(*k).agg(F.sum(rows).alias("__rows"), F.sum(n).alias("__n"), F.sum(s).alias("__s"))
        if having is not None:
            totals = totals.withColumns({f"{prefix}{c}": F.col(f"__{c}") for c in ("rows", "n", "s")}).filter(having)
        totals = totals.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(k)], "__rows", "__n", "__s")
        same = [F.col(c).eqNullSafe(F.col(f"__k_{i}")) for i, c in enumerate(k)]
        every = parts.join(totals, same).drop(*[f"__k_{i}" for i in range(len(k))])
    off = F.try_divide(s, n) - F.try_divide(F.col("__s"), F.col("__n"))
    merged = every.groupBy(*k).agg(
        F.first("__rows").alias(f"{prefix}rows"),
        F.first("__n").alias(f"{prefix}n"),
        F.first("__s").alias(f"{prefix}s"),
        F.sum(m2 + n * off * off).alias("__m2"),
        F.sum(n * off).alias("__off"),
    )
    m2_all = F.col("__m2") - F.try_divide(F.col("__off") * F.col("__off"), F.col(f"{prefix}n"))
    merged = merged.withColumn(f"{prefix}m2", F.greatest(m2_all, F.lit(0.0))).drop("__m2", "__off")
    return merged if having is None or not few_parts else merged.filter(having)


def mean_from_moments(prefix: str = "_") -> Column:
    return F.try_divide(F.col(f"{prefix}s"), F.col(f"{prefix}n"))


def pop_stddev_from_moments(prefix: str = "_") -> Column:
    """Population standard deviation; NULL when there is no non-NULL value (as ``stddev_pop``)."""
    return F.sqrt(F.try_divide(F.col(f"{prefix}m2"), F.col(f"{prefix}n")))
