"""Mixing sources to target weights by entropy balancing.

Document rates are the exponential tilt that moves the token totals of the sources to their targets
with the least relative entropy over the documents:

    minimise  sum_d (r_d log r_d - r_d + 1)   with   sum_{d in s} size_d r_d = T_s,  r_d <= max_copies

so that r_d = min(exp(lambda_s size_d), max_copies): the dual has one multiplier a source, and rates
differ between the documents of a source. The dual is convex; Newton iterations on it, held inside a
bracket, take each source's tilted total and its slope from Spark, summed over a table of (source,
size, count) that is aggregated once, until every constraint holds. Rates are then rounded into whole
copies by systematic rounding: within a source, documents are ordered by size, and a document gets one
copy more whenever the running sum of rates passes an integer and a half, so that neighbours in size
make up for each other; what is left of a target is settled by single copies of the source's smallest
documents. Running sums come from two passes (totals per partition, then within partitions) in whole
numbers, so that neither a source that holds most rows nor the partitioning changes the result.

Weights follow the sources' order: by code point, null last, 5, 2, 1, repeating. They share all of
the corpus' words; a target stops at ``max_copies`` times its source's size and the excess is shared
again by weight among the others. The sources are the mix's parameters: one row each comes to the
driver, at most ``max_sources`` of them, beyond which ValueError is raised; what is worked out for
them goes back as a small table that is joined.

Defined cases: a null or empty text has size 0, takes 0 words and, in the mixed documents, stays
with one copy; a source of empty texts has target 0; texts of any length count whole, in windows;
ties in size are ordered by the hash of doc_id and by doc_id; rows repeated under one id, source
and size share their copies evenly; a null source is a source; an empty table gives
an empty result; other columns are carried by ``mixed_documents`` and not read otherwise.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .shared import cut, unpacked, with_row
from .textbytes import SPACE_WORD, each_window, map_rows, words

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
MAX_SOURCES = 1_000_000
BROADCAST = 100_000  # sources whose numbers are broadcast
UNIT = 1 << 20  # rates are kept in units of 1 / UNIT


def sized(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, source, size) of each row of ``docs``, size being the number of words of ``text``; with
    ``carry`` the whole row as well, as the struct ``row``."""
    frame = with_row(docs, "doc_id", "source") if carry else docs.select("doc_id", "source", "text")
    kept = [f for f in frame.schema.fields if f.name != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = np.zeros(batch.num_rows, np.int64)
        text = batch.column("row").field("text") if carry else batch.column("text")
        for a, b, data, offs in each_window(text, SPACE_WORD):
            size[a:b] += np.diff(words(data, offs, SPACE_WORD)[2])
        return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(size)], names=[*(f.name for f in kept), "size"])

    return frame.mapInArrow(map_rows(run), StructType([*kept, StructField("size", LongType())]))


def source_targets(sizes: dict[str | None, int], weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES) -> dict[str | None, float]:
    """Target of each source: shares by weight, stopped at ``max_copies`` times its size, the excess
    shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = float(sum(sizes.values()))
    target: dict[str | None, float] = {}
    free = list(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > max_copies * sizes[s]]
        if not above:
            return target | share
        target |= {s: float(max_copies * sizes[s]) for s in above}
        free = [s for s in free if s not in target]
    return target


def with_values(df: DataFrame, values: dict[str | None, tuple], names: list[str]) -> DataFrame:
    """``df`` with the numbers of its source, one double column a name. The table has a row a source and
    is broadcast up to ``BROADCAST`` of them."""
    table = df.sparkSession.createDataFrame(
        [(s, *map(float, v)) for s, v in values.items()], "__source string, " + ", ".join(f"{n} double" for n in names)
    )
    table = F.broadcast(table) if len(values) <= BROADCAST else table
    return df.join(table, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def rate(multiplier: Column, size: Column, max_copies: int = MAX_COPIES) -> Column:
    """Rate of a document of ``size`` words under its source's multiplier."""
    return F.exp(F.least(multiplier * size, F.lit(math.log(max_copies))))


def balance(
    histogram: DataFrame, sizes: dict[str | None, int], targets: dict[str | None, float], max_copies: int = MAX_COPIES, tolerance: float = 1e-7,
    max_steps: int = 100,
) -> dict[str | None, float]:
    """The multiplier of each source, by Newton steps on the dual over (source, size, n); a step that
    leaves the bracket of the root halves it instead. Totals and slopes are summed by Spark in one
    job a step, over the sources that have not come to their targets yet."""
    cap = math.log(max_copies)
    found = {s: 0.0 for s in targets if sizes[s] == 0}
    low, high, at = {}, {}, {}
    for s, t in targets.items():
        if sizes[s] > 0:
            wanted = t / sizes[s]
            # every size with words is one or more, so these bound the root on both sides
            low[s], high[s] = min(0.0, math.log(max(wanted, 1e-300))), cap
            at[s] = 0.0
            if wanted >= max_copies * (1 - 1e-12):
                found[s] = at[s] = cap  # every document at its most
    for _ in range(max_steps):
        open_ = {s: (m,) for s, m in at.items() if s not in found}
        if not open_:
            break
        r = rate(F.col("m"), F.col("size"), max_copies)
        free = F.when(F.col("m") * F.col("size") < cap, F.col("size")).otherwise(0)
        sums = with_values(histogram, open_, ["m"]).groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * r).alias("tilted"), F.sum(F.col("n") * F.col("size") * free * r).alias("slope")
        )
        for x in sums.collect():  # a row a source
            s, gap = x["source"], targets[x["source"]] - x["tilted"]
            if abs(gap) <= tolerance * targets[s]:
                found[s] = at[s]
                continue
            (low if gap > 0 else high)[s] = at[s]
            step = at[s] + gap / x["slope"] if x["slope"] > 0 else math.inf
            at[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2
            if not low[s] < at[s] < high[s]:  # the bracket holds no further number
                found[s] = at[s]
    return {s: found.get(s, at.get(s, 0.0)) for s in targets}


def mix_plan(docs: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES, max_sources: int = MAX_SOURCES) -> tuple[DataFrame, dict, dict, dict]:
    """(rows, sizes, targets, multipliers): rows (doc_id, source, size, copies) of each row of
    ``docs``, and the three numbers of each source."""
    base = cut(sized(docs).withColumn("h", F.xxhash64("doc_id")))
    # distinct sizes of a source are few, and are merged in every task before the shuffle
    histogram = cut(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    per_source = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"))
    rows = per_source.limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources; give max_sources a larger value if the driver can hold them")
    sizes = {r["source"]: int(r["size"]) for r in rows}
    targets = source_targets(sizes, weights, max_copies)
    multipliers = balance(histogram, sizes, targets, max_copies)
    units = F.round(rate(F.col("m"), F.col("size"), max_copies) * UNIT).cast("long")
    # first pass: rows in the order (source, size, hash, id), with the running sum of the source's
    # rates inside the partition; a hot source is split over partitions by the range bounds
    ranged = cut(
        with_values(base, {s: (m,) for s, m in multipliers.items()}, ["m"]).withColumn("units", units).drop("m")
        .repartitionByRange(F.col("source").asc_nulls_first(), "size", "h", F.col("doc_id").asc_nulls_first())
        .withColumn("part", F.spark_partition_id())
    )
    summed = _running(ranged, F.col("units"))
    whole = lambda n: F.shiftright(n + F.lit(UNIT // 2), 20)  # noqa: E731 whole numbers only
    copies = (whole(F.col("run")) - whole(F.col("run") - F.col("units"))).alias("copies")
    rounded = cut(summed.select("part", "source", "size", "h", "doc_id", F.when(F.col("size") > 0, copies).otherwise(1).alias("copies")))
    # what whole documents leave of a target (less than one long document) goes to or comes from
    # the source's smallest documents that may still give or take a copy
    taken = {
        r["source"]: int(r["taken"])
        for r in rounded.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    }
    rest = {s: (round(targets[s] - taken[s]),) for s in targets}
    rounded = with_values(rounded, rest, ["rest"]).withColumn("rest", F.col("rest").cast("long"))
    may = (F.col("size") > 0) & F.when(F.col("rest") > 0, F.col("copies") < max_copies).otherwise(F.col("copies") > 0)
    moved = _running(rounded.withColumn("may", may), F.when(F.col("may"), F.col("size")).otherwise(0))
    copies = F.col("copies") + F.when(F.col("may") & (F.col("run") <= F.abs("rest")), F.signum("rest")).otherwise(0)
    return moved.select("doc_id", "source", "size", copies.cast("long").alias("copies")), sizes, targets, multipliers


def _running(ranged: DataFrame, value: Column) -> DataFrame:
    """``ranged`` with ``run``, the running sum of ``value`` along (size, h, doc_id) in each source:
    within partitions, plus the source's sums in earlier partitions, of which there is one row per
    partition and one more per source, a number bounded by the tasks."""
    order = ["size", "h", F.col("doc_id").asc_nulls_first()]
    within = Window.partitionBy("part", "source").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        ranged.withColumn("value", value.cast("long")).groupBy("part", "source").agg(F.sum("value").alias("value"))
        .withColumn("earlier", F.coalesce(F.sum("value").over(before), F.lit(0)))
        .select(F.col("part").alias("__part"), F.col("source").alias("__source"), "earlier")
    )
    return (
        ranged.withColumn("value", value.cast("long")).withColumn("local", F.sum("value").over(within))
        .join(F.broadcast(earlier), (F.col("part") == F.col("__part")) & F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("run", F.col("local") + F.col("earlier"))
        .drop("value", "local", "earlier", "__part", "__source")
    )


def mixture(docs: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES, max_sources: int = MAX_SOURCES) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target (its source's), taken, copies."""
    rows, sizes, targets, _ = mix_plan(docs, weights, max_copies, max_sources)
    return with_values(rows, {s: (sizes[s], targets[s]) for s in targets}, ["source_size", "target"]).select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The rows of ``docs``, with all their columns, as many times as the mix takes them.

    Rows are matched to their copies by id, source and size. Rows repeated under the same three are
    alike to the mix and share their group's copies evenly, the first ones taking what is left over.
    The texts are shuffled once: the numbering of a group's rows reuses the join's partitioning."""
    copies, *_ = mix_plan(docs, weights, max_copies)
    keys = ["no_id", "id", "no_source", "name", "size"]  # nulls are told apart from every value

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "no_id": F.col("doc_id").isNull(), "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "no_source": F.col("source").isNull(), "name": F.coalesce("source", F.lit("")),
        })

    groups = keyed(copies).groupBy(*keys).agg(F.sum("copies").alias("in_all"), F.count(F.lit(1)).alias("alike")).filter("in_all > 0")
    rows = keyed(sized(docs, carry=True)).select(*keys, "row").join(groups, keys)
    # a row's number among those alike: of one document's copies, or of all rows without id of one size
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    own = F.floor(F.col("in_all") / F.col("alike")) + F.when(number <= F.col("in_all") % F.col("alike"), 1).otherwise(0)
    taken = rows.withColumn("own", own.cast("int")).filter("own > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("own"))))
    return unpacked(taken, docs)
