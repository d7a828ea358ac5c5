"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when the smallest hash among its s-mers stands first or
last in it. Whether a k-mer is chosen depends on nothing outside it, so texts that share a passage
choose the same anchors in it. The fingerprint keeps a fixed share of the distinct anchors, those
whose hash lies under LIMIT, each with its first position, in order of position; it grows with the
text. Texts of at most WHOLE distinct anchors keep all. Likeness matches anchors of two fingerprints
positionally: common hashes vote for the offset between their positions, and the share of the
hashes of both that is common and agrees with the best offset is the likeness. Where one of the two
keeps a share, the same share of the other is compared.

``neighbour_fingerprints`` compares each document with the one that follows it by descending
doc_id, and with a version of itself whose end is replaced by that one's beginning. The order is
made by one range shuffle; the first row of each range is sent to the range before as well, so no
other data moves.

One pair of sizes serves texts of every length. Those under SHORT_TEXT code points, which have few
anchors, keep the anchors of a smaller pair as well, and two such texts are compared by these.

Defined cases: a text shorter than k is one anchor, the whole text (of the smaller size, where it
has that many code points, its smaller anchors); an empty or null text has an
empty fingerprint, and two empty fingerprints have likeness 1, an empty and another one 0; rows of
equal doc_id are ordered by the hash of their text; null ids come last; a single row follows
itself; repeated rows each follow one another; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut

K, S = 9, 4
SHORT_TEXT, SHORT_K, SHORT_S = 64, 4, 2
WHOLE, LIMIT = 256, np.uint32(1 << 29)  # one anchor in eight lies under the limit
FLUSH_ROWS, FLUSH_CHARS = 2000, 16 << 20
RANGE_BYTES = 128 << 20
_ODD = np.uint32(0x9E3779B1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def _rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` code points."""
    n = len(codes) - size + 1
    h = codes[:n].copy()
    for j in range(1, size):
        h *= _ODD
        h += codes[j : j + n]
    return _mixed(h)


def syncmers(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the closed syncmers of a text given as code points (uint32)."""
    if len(codes) < k:
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        return np.zeros(1, np.int64), _rolling(codes, len(codes))
    inner = _rolling(codes, s)
    n, width = len(codes) - k + 1, k - s + 1
    least = inner[1 : 1 + n].copy()
    for j in range(2, width - 1):
        np.minimum(least, inner[j : j + n], out=least)
    chosen = np.flatnonzero((inner[:n] <= least) | (inner[width - 1 : width - 1 + n] <= least))
    # a k-mer's hash joins those of s-mers that cover it
    h = inner[chosen]
    for j in [*range(s, k - s, s), k - s]:
        h = h * _ODD + inner[chosen + j]
    return chosen, _mixed(h)


@dataclass(frozen=True)
class Fingerprint:
    """Positions and 32-bit hashes of the kept distinct anchors at their first places, in order of
    position; whether only those under LIMIT are kept; and for a short text its finer anchors too."""

    at: np.ndarray
    h: np.ndarray
    thin: bool
    fine: Fingerprint | None = None


def fingerprint(codes: np.ndarray, k: int = K, s: int = S) -> Fingerprint:
    """Anchors of one pair of sizes at every length; texts of under SHORT_TEXT code points, which have
    few of them, keep those of the small sizes as well."""
    at, h = syncmers(codes, k, s)
    fine = fingerprint_of(*syncmers(codes, SHORT_K, SHORT_S)) if len(codes) < SHORT_TEXT else None
    return fingerprint_of(at, h, fine)


def fingerprint_of(at: np.ndarray, h: np.ndarray, fine: Fingerprint | None = None) -> Fingerprint:
    under = np.flatnonzero(h < LIMIT)
    kept, first = np.unique(h[under], return_index=True)
    at_kept = at[under][first]
    thin = len(kept) > WHOLE
    if not thin:
        every, first = np.unique(h, return_index=True)
        thin = len(every) > WHOLE
        if not thin:
            kept, at_kept = every, at[first]
    order = np.argsort(at_kept, kind="stable")
    return Fingerprint(at_kept[order], kept[order], thin, fine)


def as_text(f: Fingerprint) -> str:
    """Hash and position of each anchor, eight hexadecimal digits each; the finer ones after a dot."""
    pairs = np.empty((len(f.h), 2), ">u4")
    pairs[:, 0], pairs[:, 1] = f.h, f.at
    return pairs.tobytes().hex() + ("." + as_text(f.fine) if f.fine else "")


def likeness(a: Fingerprint, b: Fingerprint, slack: int = K) -> float:
    """Share of the hashes of both fingerprints that is common at the best offset: of the finer ones
    where both texts have them, else of those that texts of every length have."""
    if a.fine and b.fine:
        a, b = a.fine, b.fine
    if not len(a.h) or not len(b.h):
        return float(len(a.h) == len(b.h))
    at_a, h_a, at_b, h_b = a.at, a.h, b.at, b.h
    if a.thin != b.thin:  # the share that both keep
        at_a, h_a, at_b, h_b = at_a[h_a < LIMIT], h_a[h_a < LIMIT], at_b[h_b < LIMIT], h_b[h_b < LIMIT]
    common, i, j = np.intersect1d(h_a, h_b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    offset = np.sort(at_a[i] - at_b[j])
    agree = int((np.searchsorted(offset, offset + slack, "right") - np.arange(len(offset))).max())
    return agree / (len(h_a) + len(h_b) - len(common))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            got = [as_text(fingerprint(_codes(t))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(got, pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, text, next text) of the rows of each range, which arrive in order; the last row of
    a range is the one borrowed from the next."""
    before = None
    for batch in batches:
        for bucket, borrowed, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "borrowed", "doc_id", "text")), strict=True):
            if before is not None and before[0] == bucket:
                yield before[1], before[2], text
            before = None if borrowed else (bucket, doc_id, text)


PAIR_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def neighbour_fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per row of ``docs``: its fingerprint, that of its edited text (the last half replaced by as
    many first code points of the next document) and the likeness of its own to the edited and to
    the next document's."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "h", F.xxhash64("text")
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").asc()]
    # the ranges are made from the keys alone, as many as the texts need, and no fewer than shuffles have
    keys = cut(texts.select("doc_id", "h", F.octet_length("text").alias("bytes")))
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))
    # first key of each range: as many rows as ranges
    heads = (
        keys.repartitionByRange(ranges, *order)
        .withColumn("range", F.spark_partition_id())
        .groupBy("range")
        .agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), (-1 - F.col("h")).alias("turned"))).alias("head"))
        .orderBy("range")
        .select("head.*")
        .collect()
    )
    # as sortable keys: nulls last, ids descending, hashes ascending
    keys = [((0, -r["doc_id"]) if r["known"] else (1, 0)) + (-1 - r["turned"],) for r in heads]
    shared = docs.sparkSession.sparkContext.broadcast(np.array(keys, np.int64).reshape(-1, 3))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = shared.value
        known = [tuple(x) for x in heads.tolist()]
        index = {key: i for i, key in enumerate(known)}
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            own = [((1, 0) if i is None else (0, -i)) + (h,) for i, h in zip(ids, hashes, strict=True)]
            bucket = [max(bisect_right(known, key) - 1, 0) for key in own]
            lead = [i for i, key in enumerate(own) if key in index]
            take = pa.array(list(range(len(ids))) + lead, pa.int64())
            buckets = bucket + [(index[own[i]] - 1) % len(known) for i in lead]
            borrowed = [False] * len(ids) + [True] * len(lead)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int64()), pa.array(borrowed), batch.column(0).take(take), batch.column(2).take(take), batch.column(1).take(take)],
                names=["bucket", "borrowed", "doc_id", "h", "text"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        last: tuple[str, Fingerprint] | None = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [c.split()[0] for c in PAIR_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for doc_id, text, following in _pairs(batches):
            n = len(text)
            edited = text[: n - n // 2] + following[: n // 2]
            own = last[1] if last and last[0] == text else fingerprint(_codes(text))
            after = own if following == text else fingerprint(_codes(following))
            last = (following, after)
            changed = own if edited == text else fingerprint(_codes(edited))
            rows.append((
                doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(own), as_text(changed),
                likeness(own, changed), likeness(own, after),
            ))
            size += len(rows[-1][3]) + len(rows[-1][4])
            if len(rows) == FLUSH_ROWS or size > FLUSH_CHARS:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()

    placed = texts.mapInArrow(place, "bucket long, borrowed boolean, doc_id long, h long, text string")
    within = [F.col("bucket").asc(), F.col("borrowed").asc(), *order]
    return placed.repartitionById(max(len(heads), 1), F.col("bucket").cast("int")).sortWithinPartitions(*within).mapInArrow(compare, PAIR_SCHEMA)
