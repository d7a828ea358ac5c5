"""Prefix trie of conversations, rolled up by centroid decomposition.

A turn is known by the SHA-256 of its role and text, so that texts are read once and never shuffled.
A prefix is known by its depth and a 128-bit exclusive-or of hashes of (turn, place); running totals
in blocks of turns give every prefix of every conversation, and one aggregation gives the nodes with
their members. The parent-edge forest then has for each node its smallest member, its parent's key
and its weight: the member turns at or below it, known from the members alone.

Rollup: in every component the deepest node that carries at least half the component's weight is its
centroid, and the nodes at least as heavy are just the path from it to the component's top. Cutting
at the centroid leaves components of at most half the weight: one below each of its children, found
by looking up the smallest member's prefix one turn below the centroid, and the rest above. The total
below the centroid goes to the centroid and is added along its path to the top. So components halve
each round whatever the depth of the trie. Rounds run as Spark joins while a component weighs over
``bound``; lighter ones are dealt out whole and finish the same recursion inside the tasks.

Defined cases: rows without a conversation id belong to none and are left out; null roles and texts
are empty; turns of one number stand in the order of their digests; repeated rows are turns of their
own; texts of any length are hashed whole; the remainder by five keeps the sign of the id; an empty
table gives no row, not even a root; other columns are not read. A conversation or a node may hold
any share of all rows: turns are numbered by ranges, running totals are taken in blocks, and joins
on a hot key go through ``shared.lookup`` or are left to AQE's split of skewed partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, lookup

FAMILY = 5  # ids that share a base conversation
HEAD = 9  # head lengths are 0 to 8
BLOCK = 1024  # turns a running total is taken over in one go
BOUND = 1 << 16  # weight of a component that a task finishes alone
FEW = 100_000  # components whose table is broadcast
IDS = 4096  # ids joined into one piece of text before a digest reads them


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, part, i, k, b): the place i (from 0) of each turn in its conversation, with digest and
    UTF-8 bytes of its text; and (conv, part, n, before): the turns of a conversation in a range
    and in the ranges before. Ranges are dealt by (conv, turn, digest), so that a conversation of
    any length spreads over many."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("k"),
        F.octet_length(text).cast("long").alias("b"),
    )
    dealt = cut(turns.repartitionByRange("conv", "turn", "k").withColumn("part", F.spark_partition_id()))
    runs = dealt.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    here = Window.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_first(), "k")
    return dealt.withColumn("i", F.row_number().over(here).cast("long") - 1).drop("turn"), runs


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, m, d, k, b): the turns of the rebuilt conversations with depth d (from 1) of m; and
    (conv, m) of all conversations, turnless ones too."""
    rows, runs = numbered(conversations)
    runs = cut(runs)
    conv = F.col("conv")
    head = F.when(conv % FAMILY == 0, 0).otherwise(F.crc32(conv.cast("string").cast("binary")) % HEAD).cast("long")
    sizes = runs.groupBy("conv").agg(F.sum("n").alias("n"))
    info = sizes.select("conv", "n", head.alias("h"), (conv - conv % FAMILY).alias("base"))
    info = info.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
    info = info.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    info = cut(info.withColumn("m", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    spread = runs.join(info.select("conv", "h", "taken", "m"), "conv").drop("n")
    own = rows.join(spread, ["conv", "part"]).withColumn("i", F.col("i") + F.col("before")).filter("i >= h")
    own = own.select("conv", "m", (F.col("i") - F.col("h") + F.col("taken") + 1).alias("d"), "k", "b")
    first = rows.filter(conv % FAMILY == 0).join(runs.select("conv", "part", "before"), ["conv", "part"])
    first = first.withColumn("i", F.col("i") + F.col("before")).filter(F.col("i") < HEAD - 1)  # eight rows a base
    heads = info.select("conv", "m", "base", "taken").join(first.select(conv.alias("base"), "i", "k", "b"), "base").filter("i < taken")
    return cut(own.unionByName(heads.select("conv", "m", (F.col("i") + 1).alias("d"), "k", "b"))), info.select("conv", "m")


def _running(turns: DataFrame, longest: int) -> DataFrame:
    """(conv, d, f1, f2) with the running exclusive-or (x1, x2) over d of each conversation, taken in
    blocks and, over the blocks, by the same function."""
    blocks = turns.withColumn("block", F.floor((F.col("d") - 1) / BLOCK))
    here = Window.partitionBy("conv", "block").orderBy("d")
    out = blocks.withColumns({f"x{j}": F.bit_xor(f"f{j}").over(here) for j in (1, 2)})
    if longest > BLOCK:
        totals = blocks.groupBy("conv", "block").agg(F.bit_xor("f1").alias("f1"), F.bit_xor("f2").alias("f2"))
        before = _running(totals.withColumn("d", F.col("block") + 1).drop("block"), -(-longest // BLOCK))
        before = before.select("conv", (F.col("d") - 1).alias("block"), *[F.col(f"x{j}").bitwiseXOR(F.col(f"f{j}")).alias(f"y{j}") for j in (1, 2)])
        out = out.join(before, ["conv", "block"]).withColumns({f"x{j}": F.col(f"x{j}").bitwiseXOR(F.col(f"y{j}")) for j in (1, 2)})
    return out.drop("block", "y1", "y2")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, m, d, b, x1, x2, p1, p2): each prefix's key and that of the prefix one turn shorter.
    The root's key is (0, 0) at depth 0."""
    hashed = turns.withColumns({"f1": F.xxhash64("k", "d"), "f2": F.xxhash64(F.lit(2), "d", "k")})
    longest = turns.agg(F.max("d")).first()[0] or 0
    out = _running(hashed, longest)
    return out.select("conv", "m", "d", "b", "x1", "x2", *[F.col(f"x{j}").bitwiseXOR(F.col(f"f{j}")).alias(f"p{j}") for j in (1, 2)])


KEY = ["x1", "x2", "d"]
TOP = ["t1", "t2", "td"]


def nodes_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: key, parent's key, smallest member and the parent's, members, children,
    bytes of the last text and weight. ``paths`` is ``prefixes`` of all conversations."""
    members = [
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.max("b").alias("b"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    ]
    found = paths.groupBy(*KEY).agg(*members, F.sum(F.col("m") - F.col("d") + 1).alias("weight"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.sum(F.col("m") + 1).alias("weight")).filter("n_convs > 0")
    none = F.lit(None).cast("long")
    found = cut(found.unionByName(root.withColumns({"x1": zero, "x2": zero, "d": zero, "b": zero, "p1": none, "p2": none})))
    below = found.filter("d > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2"), (F.col("d") - 1).alias("d"))
    children = cut(below.agg(F.count(F.lit(1)).alias("n")))
    parents = found.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("d").alias("pd"), F.col("conv").alias("parent_conv_id"))
    full = found.join(children.withColumnRenamed("n", "n_children"), KEY, "left").fillna(0, ["n_children"])
    counts = children.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("d").alias("pd"), "n")
    total = children.agg(F.sum("n")).first()[0] or 0
    return lookup(full.withColumn("pd", F.col("d") - 1), parents, ["p1", "p2", "pd"], counts, total).drop("pd")


def _few(table: DataFrame) -> DataFrame:
    """A written table of one row a heavy component, broadcast where it is small enough; beyond,
    the join is shuffled and AQE splits the components that are still large."""
    return F.broadcast(table) if table.count() <= FEW else table


def _same(a: tuple[str, str, str], b: tuple[str, str, str]) -> Column:
    return (F.col(a[0]) == F.col(b[0])) & (F.col(a[1]) == F.col(b[1])) & (F.col(a[2]) == F.col(b[2]))


def rolled_up(nodes: DataFrame, paths: DataFrame, values: tuple[str, str], bound: int = BOUND) -> DataFrame:
    """``nodes`` with the columns named in ``values`` replaced by their sums over each subtree."""
    v1, v2 = values
    zero = F.lit(0).cast("long")
    carried = [c for c in nodes.columns if c not in (*KEY, "p1", "p2", "weight", "conv", v1, v2)]
    state = nodes.select(*KEY, "p1", "p2", "weight", "conv", F.struct(*carried).alias("rest"), F.col(v1).cast("long").alias("v1"), F.col(v2).cast("long").alias("v2"))
    whole = nodes.agg(F.max("weight")).first()[0] or 0
    active = state.withColumns({"a1": zero, "a2": zero, "t1": zero, "t2": zero, "td": zero, "total": F.lit(whole).cast("long")})
    light, done = [], []
    steps = paths.select(F.col("conv"), F.col("d").alias("at"), F.col("x1").alias("s1"), F.col("x2").alias("s2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    while True:
        light.append(active.filter(F.col("total") <= bound).drop("total"))
        heavy = active.filter(F.col("total") > bound)
        path = F.col("weight") * 2 >= F.col("total")  # the centroid and what lies between it and the top
        centre = heavy.filter(path).groupBy(*TOP).agg(F.max(F.struct("d", "x1", "x2", "weight")).alias("c"))
        centre = cut(centre.select(*TOP, F.col("c.d").alias("cd"), F.col("c.x1").alias("c1"), F.col("c.x2").alias("c2"), F.col("c.weight").alias("cw")))
        if centre.isEmpty():
            break
        placed = heavy.join(_few(centre), TOP)
        # one turn below the centroid on the way to the node; a node not deeper than it finds itself
        placed = placed.withColumn("at", F.when(F.col("d") > F.col("cd"), F.col("cd") + 1).otherwise(F.col("d")))
        placed = placed.join(steps, ["conv", "at"], "left")
        under = F.coalesce((F.col("d") > F.col("cd")) & (F.col("q1") == F.col("c1")) & (F.col("q2") == F.col("c2")), F.lit(False))
        itself = _same(("x1", "x2", "d"), ("c1", "c2", "cd"))
        placed = placed.withColumns({"under": under, "itself": itself, "on_path": path & ~itself})
        placed = placed.withColumns({
            "n1": F.when(F.col("under"), F.col("s1")).otherwise(F.col("t1")),
            "n2": F.when(F.col("under"), F.col("s2")).otherwise(F.col("t2")),
            "nd": F.when(F.col("under"), F.col("at")).otherwise(F.col("td")),
        }).drop("s1", "s2", "q1", "q2", "at")
        placed = cut(placed)
        sums = placed.filter("under or itself").groupBy(*TOP).agg(F.sum("v1").alias("sum1"), F.sum("v2").alias("sum2"))
        below = placed.filter("under").groupBy("n1", "n2", "nd").agg(F.max("weight").alias("left")).filter(F.col("left") > bound)
        above = placed.filter("itself").select(*[F.col(t).alias(n) for t, n in zip(TOP, ("n1", "n2", "nd"), strict=True)], (F.col("total") - F.col("cw")).alias("left"))
        totals = cut(below.unionByName(above))
        placed = placed.join(_few(cut(sums)), TOP)
        result = {"v1": F.col("sum1") + F.col("a1"), "v2": F.col("sum2") + F.col("a2")}
        done.append(placed.filter("itself").withColumns(result).select(*KEY, "conv", "rest", "v1", "v2"))
        onto = {
            "a1": F.when(F.col("on_path"), F.col("a1") + F.col("sum1")).otherwise(F.col("a1")),
            "a2": F.when(F.col("on_path"), F.col("a2") + F.col("sum2")).otherwise(F.col("a2")),
            "weight": F.when(F.col("on_path"), F.col("weight") - F.col("cw")).otherwise(F.col("weight")),
        }
        rest = placed.filter("not itself").withColumns(onto).drop(*TOP, "total").join(_few(totals), ["n1", "n2", "nd"], "left")
        renamed = {n: F.col(m) for n, m in zip(TOP, ("n1", "n2", "nd"), strict=True)} | {"total": F.coalesce("left", F.lit(0))}
        active = cut(rest.withColumns(renamed).select(*active.columns))
    gathered = light[0]
    for more in light[1:]:
        gathered = gathered.unionByName(more)
    dealt = gathered.repartition(*TOP).sortWithinPartitions(*TOP)
    kind = dealt.schema["rest"].dataType.simpleString()
    out = dealt.mapInArrow(_finish, f"x1 long, x2 long, d long, conv long, rest {kind}, v1 long, v2 long")
    for more in done:
        out = out.unionByName(more)
    return out.select(*KEY, "conv", "rest.*", F.col("v1").alias(v1), F.col("v2").alias(v2))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree sums of whole components, which arrive one after the other."""
    held: list[pa.RecordBatch] = []

    def summed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {c: table[c].to_numpy() for c in (*KEY, *TOP, "weight", "v1", "v2", "a1", "a2")}
        columns |= {c: table[c].fill_null(0).to_numpy() for c in ("p1", "p2")}
        s1, s2 = component_sums(columns)
        out = table.select([*KEY, "conv", "rest"]).append_column("v1", pa.array(s1)).append_column("v2", pa.array(s2))
        yield from out.combine_chunks().to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= BOUND // 2:
            table = pa.Table.from_batches(held)
            tops = [table[c].to_numpy() for c in TOP]
            same = np.logical_and.reduce([t == t[-1] for t in tops])
            last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if last:
                yield from summed(table.slice(0, last))
            held = table.slice(last).to_batches()
    if held:
        yield from summed(pa.Table.from_batches(held))


def _nearest(stop: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The nearest node at or above each that is marked in ``stop``, by doubling steps."""
    at = np.where(stop, np.arange(len(stop)), parent)
    while True:
        further = at[at]
        if (further == at).all():
            return at
        at = further


def component_sums(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Subtree sums of v1 and v2 plus the carried a1 and a2, for all nodes of whole components, by
    the same cuts as between tasks, in all components at once."""
    n = len(c["d"])
    here = pd.MultiIndex.from_arrays([c["x1"], c["x2"], c["d"]])
    parent = here.get_indexer(pd.MultiIndex.from_arrays([c["p1"], c["p2"], c["d"] - 1]))
    top = (c["x1"] == c["t1"]) & (c["x2"] == c["t2"]) & (c["d"] == c["td"])
    parent = np.where(top, np.arange(n), parent)
    weight, sums = c["weight"].copy(), [c["a1"].copy(), c["a2"].copy()]
    alive = np.ones(n, bool)
    while alive.any():
        of = _nearest(top, parent)
        path = alive & (2 * weight >= weight[of])
        at = np.flatnonzero(path)
        at = at[np.lexsort((c["d"][at], of[at]))]
        deepest = at[np.append(of[at][1:] != of[at][:-1], True)]
        centre = np.zeros(n, np.int64)
        centre[of[deepest]] = deepest
        centre = centre[of]
        cuts = np.zeros(n, bool)
        cuts[deepest] = True
        under = alive & (_nearest(top | cuts, parent) == centre)
        above = path & ~cuts
        for s, v in zip(sums, (c["v1"], c["v2"]), strict=True):
            total = np.zeros(n, np.int64)
            np.add.at(total, centre[under], v[under])
            s[above] += total[centre[above]]
            s[deepest] += total[deepest]
        weight[above] -= weight[centre[above]]
        alive[deepest] = False
        top = top | cuts | cuts[parent]  # the children of a centroid head components of their own
    return sums[0], sums[1]


def end_digests(ends: DataFrame) -> DataFrame:
    """(x1, x2, d, ends_sha256) of the nodes where conversations end: SHA-256 of their ids in
    ascending order. Ids are joined piece by piece in sorted ranges, and only the pieces of a node
    meet in the task that runs its digest over them."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KEY, "conv", "ids"]
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in KEY]
            ids = batch.column("conv").to_numpy()
            new = np.ones(len(ids), bool)
            new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
            first = np.flatnonzero(new)
            first = np.unique(np.concatenate([np.arange(a, b, IDS) for a, b in zip(first, [*first[1:], len(ids)], strict=True)]))
            text = ids.astype(str)
            joined = [",".join(text[a:b]) for a, b in zip(first, [*first[1:], len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays([*[pa.array(x[first]) for x in columns], pa.array(ids[first]), pa.array(joined)], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KEY, "ends_sha256"]
        key, state = None, None
        for batch in batches:
            out = []
            for *this, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")], strict=True):
                if this != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = this, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=names)

    kind = "x1 long, x2 long, d long"
    dealt = ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    joined = dealt.mapInArrow(pieces, f"{kind}, conv long, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "conv").mapInArrow(digests, f"{kind}, ends_sha256 string")


def conversation_trie(conversations: DataFrame, bound: int = BOUND) -> DataFrame:
    """One row per node of the rebuilt conversations' trie: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(conversations)
    paths = cut(prefixes(turns))
    nodes = nodes_of(paths, convs).withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("b"),
    })
    summed = rolled_up(cut(nodes), paths, ("n_leaves", "saved_tokens"), bound)
    zero = F.lit(0).cast("long")
    ends = paths.filter("d = m").select(*KEY, "conv").unionByName(convs.filter("m = 0").select(*[zero.alias(c) for c in KEY], "conv"))
    out = summed.join(end_digests(ends), KEY, "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )
