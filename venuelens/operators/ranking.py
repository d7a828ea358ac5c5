"""Ranking operators: top-k per group, percent rank on a value histogram, top groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def top_per_group(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    k: int,
    method: str = "rank",
    name: str = "rank",
) -> DataFrame:
    """Rows ranked ``<= k`` within each group (ties may give more than ``k`` rows for ranks).

    The rank filter directly on the window lets Catalyst insert ``WindowGroupLimit`` before and
    after the shuffle, so a hot group ships at most ``k`` (plus ties) rows per map partition.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    ranked = df.withColumn(name, _RANKERS[method]().over(w))
    return ranked.filter(F.col(name) <= k)


def value_ranks(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """``percent_rank()`` of every distinct (group, value): (rows below) / (n - 1), 0 for a single row.

    Rows are counted per (group, value) with map-side partial aggregation, in the value's own type;
    NULL comes first, as in Spark's ascending order. The counts are range-partitioned by (group,
    value) and written once, so a group spans as many partitions as its values need. Running counts
    are taken inside each partition, and one sum per (group, partition) adds what lies before.
    """
    g = list(group)
    hist = df.groupBy(*g, value).agg(F.count(F.lit(1)).alias("__c"))
    ranged = materialize(
        hist.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*g, value]]).withColumn("__part", F.spark_partition_id())
    )
    along = Window.partitionBy(*g).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*g, "__part").agg(F.sum("__c").alias("__s"))
    sums = sums.select(
        *[F.col(c).alias(f"__g_{i}") for i, c in enumerate(g)],
        F.col("__part").alias("__p"),
        F.coalesce(F.sum("__s").over(along), F.lit(0)).alias("__before"),
        F.sum("__s").over(Window.partitionBy(*g)).alias("__n"),
    )
    inside = Window.partitionBy("__part", *g).orderBy(F.col(value).asc_nulls_first())
    local = ranged.withColumn(
        "__below", F.coalesce(F.sum("__c").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    same = [local["__part"] == sums["__p"]] + [local[c].eqNullSafe(sums[f"__g_{i}"]) for i, c in enumerate(g)]
    n = F.col("__n")
    rank = F.when(n <= 1, F.lit(0.0)).otherwise((F.col("__below") + F.col("__before")) / (n - F.lit(1)))
    return local.join(sums, same).select(*g, value, rank.alias(out))


def measure_ranks(df: DataFrame, group: Sequence[str], measures: Sequence[str], out: str = "pct_rank", ranges: int = 64) -> DataFrame:
    """``percent_rank()`` of every distinct value of several numeric measures in one pass: a written
    table (group, measure: its number, value: double, ``out``).

    The measures stand below each other, and rows are counted per value. Approximate quantiles of a
    group's distinct values cut it into ``ranges`` that a window can hold, so that a hot group takes
    many tasks; running counts inside a range and the exact totals of the ranges before it give the
    ranks, whatever the quantiles' error. NULL comes first, as in Spark's ascending order.
    """
    g = list(group)
    stacked = F.array(*[F.struct(F.lit(i).alias("measure"), F.col(m).cast("double").alias("value")) for i, m in enumerate(measures)])
    counts = df.select(*g, F.inline(stacked)).groupBy(*g, "measure", "value").agg(F.count(F.lit(1)).alias("__c"))
    keys = [*g, "measure"]

    def with_keys(right: DataFrame, left: DataFrame, on: Sequence[str]) -> DataFrame:
        named = right.withColumnsRenamed({c: f"__k_{c}" for c in on})
        return left.join(named, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in on]).drop(*[f"__k_{c}" for c in on])

    cuts = F.percentile_approx("value", [i / ranges for i in range(1, ranges)], 1000).alias("__cuts")
    placed = with_keys(counts.groupBy(*keys).agg(cuts), counts, keys)
    below = F.size(F.filter("__cuts", lambda c: c <= F.col("value")))
    placed = placed.withColumn("__range", F.when(F.col("value").isNull(), -1).otherwise(below)).drop("__cuts")
    sums = placed.groupBy(*keys, "__range").agg(F.sum("__c").alias("__s"))
    along = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    sums = sums.select(*keys, "__range", F.sum("__s").over(along).alias("__before"), F.sum("__s").over(Window.partitionBy(*keys)).alias("__n"))
    inside = Window.partitionBy(*keys, "__range").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__below", F.coalesce(F.sum("__c").over(inside), F.lit(0)))
    n = F.col("__n")
    rank = F.when(n <= 1, F.lit(0.0)).otherwise((F.col("__below") + F.coalesce("__before", F.lit(0))) / (n - F.lit(1)))
    return materialize(with_keys(sums, local, [*keys, "__range"]).select(*keys, "value", rank.alias(out)))


def join_ranks(df: DataFrame, ranks: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """``df`` with the rank of its (group, value), by a NULL-safe join whose strategy the planner picks
    from the written table's real size."""
    keys = [*group, value]
    named = ranks.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(keys)], F.col(out))
    same = [df[c].eqNullSafe(named[f"__k_{i}"]) for i, c in enumerate(keys)]
    return df.join(named, same).drop(*[f"__k_{i}" for i in range(len(keys))])


def percent_ranks_by_histogram(df: DataFrame, group: Sequence[str], values: Sequence[str], outs: Sequence[str]) -> DataFrame:
    """``percent_rank() OVER (PARTITION BY group ORDER BY v)`` for each ``v`` in ``values``, without
    windowing the rows; see :func:`value_ranks`."""
    ranked = df
    for v, name in zip(values, outs, strict=True):
        ranked = join_ranks(ranked, value_ranks(df, group, v, name), group, v, name)
    return ranked


def percent_rank_by_histogram(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Single-measure form of :func:`percent_ranks_by_histogram`."""
    return percent_ranks_by_histogram(df, group, [value], [out])


def top_groups(
    df: DataFrame, group: str, measure: str, k: int, out: str = "total"
) -> DataFrame:
    """The ``k`` groups with the largest sum of ``measure`` (ties broken by group key)."""
    agg = df.groupBy(group).agg(F.sum(measure).alias(out))
    return agg.orderBy(F.col(out).desc(), F.col(group).asc()).limit(k)


def rows_of_top_groups(df: DataFrame, group: str, measure: str, k: int) -> DataFrame:
    """Rows of ``df`` whose group is among the top ``k`` by total ``measure``.

    The top-k frame has at most ``k`` rows, a proven bound, so it is broadcast.
    """
    tops = top_groups(df, group, measure, k).select(group)
    return df.join(F.broadcast(tops), group, "left_semi")
