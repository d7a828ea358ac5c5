"""Entity segmentation: feature selection, standardisation and multi-start k-means.

Everything runs distributed; only candidate centres (about 4k a start) and a few scalars reach the
driver.
"""

from __future__ import annotations

import random
import warnings
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_stats(df: DataFrame, features: Sequence[str]) -> dict:
    """Row count, mean and population deviation per feature: one aggregate row."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}")]
    return df.agg(*aggs).first().asDict()


def standardize(
    df: DataFrame, features: Sequence[str], suffix: str = "_z", stats: dict | None = None
) -> DataFrame:
    """Centre to mean 0 and scale to population deviation 1; a constant feature becomes 0.

    The per-feature mean and deviation are one aggregate row, read back as literals.
    """
    stats = stats or feature_stats(df, features)
    out = df
    for f in features:
        m, s = stats[f"m_{f}"], stats[f"s_{f}"]
        m = 0.0 if m is None else float(m)
        scaled = (F.col(f) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
        out = out.withColumn(f + suffix, scaled.cast("double"))
    return out


# Coordinates are read to a multiple of 2^-20: sums of such numbers are exact below 2^33, in any order,
# so that a fit does not depend on how the rows lie in partitions.
GRID = float(1 << 20)
INIT_ROUNDS = 2  # draws of further candidates after the first centre
SPARE_ROUNDS = 10  # more of them where there are still fewer candidates than centres

Centres = list[tuple[float, ...]]


class Blocks:
    """The coordinates of all rows as numpy blocks in the executors, kept between passes.

    A fit takes dozens of passes over the same rows with nothing but other centres, and all starts go
    through each pass together. Rows come over as Arrow batches once; a pass sends the centres out
    and merges one small table a partition in a tree. Blocks lost with an executor are read again.
    Classic sessions only (an RDD keeps the blocks); no pass sends rows to the driver.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], key: str):
        width = len(features) + 1

        def packed(batches):
            for batch in batches:
                if batch.num_rows:
                    block = np.column_stack([batch.column(i).to_numpy().view(np.float64) for i in range(width)])
                    yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.large_binary())], names=["block"])

        cells = [(F.round(F.col(f) * GRID) / GRID).alias(f"f{i}") for i, f in enumerate(features)]
        rows = df.select(F.xxhash64(key).alias("h"), *cells).mapInArrow(packed, "block binary")
        self.rdd = rows.rdd.map(lambda r: np.frombuffer(r[0], np.float64).reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)

    def merged(self, run, merge, start):
        """``run(hashes, coordinates)`` of every block, merged two by two by ``merge``."""
        parts = self.rdd.map(lambda b: run(b[:, 0].copy().view(np.uint64), b[:, 1:]))
        return parts.treeAggregate(start, merge, merge)

    def close(self) -> None:
        self.rdd.unpersist()


def _nearest():
    """A function that the workers can have without this module: squared distance to, and number of, the
    nearest of the centres of one start; a tie goes to the smaller number."""

    def nearest(x, centres):
        best, at = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
        for j, c in enumerate(centres):
            d = np.zeros(len(x))
            for f, v in enumerate(c):
                d += (x[:, f] - v) ** 2
            closer = d < best
            best[closer], at[closer] = d[closer], j
        return best, at

    return nearest


def _draws():
    """Numbers in [0, 1) out of key hashes, a seed and a round, for the workers."""

    def draws(h, seed, round_no):
        with np.errstate(over="ignore"):
            z = h + np.uint64((seed * 0x9E3779B97F4A7C15 + round_no * 0xD1B54A32D192ED03) % 2**64)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))) / 2.0**64

    return draws


def lloyd_step(blocks: Blocks, starts: Mapping[int, Centres]) -> dict[tuple[int, int], tuple]:
    """One step of k-means for every start at once: of the rows nearest to each centre, by (start,
    number), their count, squared distance and the mean of each dimension; none for no row."""
    nearest = _nearest()

    def run(_, x):
        out = {}
        for s, centres in starts.items():
            d, at = nearest(x, centres)
            columns = [np.bincount(at, w, len(centres)) for w in (None, d, *x.T)]
            out |= {(s, j): np.array([c[j] for c in columns]) for j in range(len(centres)) if columns[0][j]}
        return out

    def merge(a, b):
        return {k: a[k] + b[k] if k in a and k in b else a.get(k, b.get(k)) for k in a.keys() | b.keys()}

    sums = blocks.merged(run, merge, {})
    return {k: (int(v[0]), float(v[1]), tuple((v[2:] / v[0]).tolist())) for k, v in sums.items()}


def _first_centres(blocks: Blocks, k: int, seeds: Sequence[int]) -> dict[int, Centres]:
    """Start centres by k-means||: a first row by hash of its key, rounds that keep a row with
    probability 2k times its share of the distance left (so about 2k a round), and weighted
    k-means++ over the few candidates, each counted by the rows nearest to it."""
    nearest, draws = _nearest(), _draws()

    def first(h, x):
        u = {s: draws(h, s, 0) for s in seeds}
        return {s: min((float(v[i]), *x[i].tolist()) for i in np.flatnonzero(v == v.min())) for s, v in u.items()}

    def least(a, b):
        return {s: min(a.get(s, b.get(s)), b.get(s, a.get(s))) for s in a.keys() | b.keys()}

    candidates: dict[int, Centres] = {s: [c[1:]] for s, c in sorted(blocks.merged(first, least, {}).items())}
    for round_no in range(1, 1 + INIT_ROUNDS + SPARE_ROUNDS):
        wanted = {s: c for s, c in candidates.items() if round_no <= INIT_ROUNDS or len(set(c)) < k}
        left = {s: 0.0 for s in wanted}
        for (s, _), (_, cost, _) in (lloyd_step(blocks, wanted) if wanted else {}).items():
            left[s] += cost
        share = {s: 2 * k / x for s, x in left.items() if x > 0}
        if not share:
            break

        def kept(h, x, share=share, wanted=wanted, round_no=round_no):
            return [(s, tuple(c)) for s in share for c in x[draws(h, s, round_no) < nearest(x, wanted[s])[0] * share[s]].tolist()]

        for s, c in sorted(blocks.merged(kept, lambda a, b: a + b, [])):  # about 2k rows a start
            candidates[s].append(c)
    weight = {at: n for at, (n, _, _) in (lloyd_step(blocks, candidates) if candidates else {}).items()}
    return {s: _plus_plus([(c, weight[s, j]) for j, c in enumerate(found) if (s, j) in weight], k, s) for s, found in candidates.items()}


def _gap(a: Sequence[float], b: Sequence[float]) -> float:
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def _plus_plus(points: list[tuple[tuple[float, ...], int]], k: int, seed: int) -> Centres:
    """At most ``k`` distinct centres among weighted points, drawn by distance, then moved to the means
    of the points nearest to them until they rest."""
    draw = random.Random(seed)
    centres = [draw.choices([p for p, _ in points], [w for _, w in points])[0]]
    while len(centres) < k:
        odds = [w * min(_gap(p, c) for c in centres) for p, w in points]
        if not any(odds):
            break
        centres.append(draw.choices([p for p, _ in points], odds)[0])
    for _ in range(30):
        nearest = [min(range(len(centres)), key=lambda j, p=p: _gap(p, centres[j])) for p, _ in points]
        moved = []
        for j, c in enumerate(centres):
            own = [(p, w) for (p, w), at in zip(points, nearest, strict=True) if at == j]
            total = sum(w for _, w in own)
            moved.append(tuple(sum(p[f] * w for p, w in own) / total for f in range(len(c))) if own else c)
        if moved == centres:
            break
        centres = moved
    return centres


def fit_segments(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    k: int = 4,
    seeds: Sequence[int] = tuple(range(42, 52)),
    max_iter: int = 300,
    tol: float = 1e-4,
    rest: float = 1e-4,
) -> Centres:
    """Centres of the best of several k-means starts (lowest cost), in ascending order, which numbers
    the segments. Fewer than ``k`` where there are not as many distinct rows; none for no row.

    A start counts as finished when its centres' squared moves add up to ``tol``; the best one then
    goes on alone until none of its centres moves by more than ``rest``. Every pass takes all starts
    that still move. Draws hash the key and sums are exact (``GRID``), so the fit is the same for any
    layout of the input, and its tasks are as many as the input's.
    """
    blocks = Blocks(df, features, key)

    def moved(moving: dict[int, Centres]) -> Iterator[tuple[int, float, list[float]]]:
        step = lloyd_step(blocks, moving)
        for s, centres in list(moving.items()):
            own = {j: step[s, j] for j in range(len(centres)) if (s, j) in step}
            moving[s] = [own[j][2] if j in own else c for j, c in enumerate(centres)]
            yield s, sum(cost for _, cost, _ in own.values()), [_gap(a, b) for a, b in zip(centres, moving[s], strict=True)]

    try:
        moving = _first_centres(blocks, k, seeds)
        done: list[tuple[float, int, Centres]] = []
        passes = 0
        while moving:
            passes += 1
            for s, cost, gaps in moved(moving):
                if sum(gaps) <= tol or passes >= max_iter:
                    done.append((float(f"{cost:.9e}"), s, moving.pop(s)))
        best = {s: c for _, s, c in sorted(done)[:1]}
        while best:
            passes += 1
            ((s, _, gaps),) = moved(best)
            if max(gaps) <= rest * rest:
                return sorted(best[s])
            if passes >= max_iter:
                warnings.warn(f"the best start stopped unconverged after {passes} passes", stacklevel=2)
                return sorted(best[s])
        return []
    finally:
        blocks.close()


def _squared(dims: Sequence[str], centre: Sequence[float]) -> Column:
    parts = [F.col(f) - F.lit(float(c)) for f, c in zip(dims, centre, strict=True)]
    return sum((p * p for p in parts[1:]), parts[0] * parts[0])


def assign_nearest(
    df: DataFrame, centres: Sequence[Sequence[float]], features: Sequence[str], out: str = "segment"
) -> DataFrame:
    """Number of the nearest centre (squared Euclidean distance; a tie goes to the smaller number)."""
    if not centres:
        return df.withColumn(out, F.lit(None).cast("int"))
    distances = [F.struct(_squared(features, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return df.withColumn(out, F.array_min(F.array(*distances))["i"].cast("int"))


def centroid_frame(spark, centres: Sequence[Sequence[float]], features: Sequence[str]) -> DataFrame:
    """One row per centre: segment and coordinate per (scaled) feature."""
    schema = "segment int, " + ", ".join(f"`{f}` double" for f in features)
    return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centres)], schema)
