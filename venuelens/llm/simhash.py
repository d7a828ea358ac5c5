"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``radius`` bits exactly when some value lies within half the
radius of each, so every distinct fingerprint emits all variants within ``radius // 2`` flipped
bits (65 for radius 2 of 64 bits) and fingerprints meet on equal variants in one shuffle. Any two
that meet are at most 2 * (radius // 2) bits apart, so a bucket is linked through its smallest
member; a bucket holds at most as many distinct fingerprints as the ball has values, whatever the
data. Odd radii also need the pairs one flip apart from a shared ball and are not offered.

Copies of a text share one fingerprint and are folded before anything is shuffled on variants, so
a group of copies of any size costs one row. Components are found by label propagation over the
links of distinct fingerprints, checkpointed each round.

Defined cases: a null or empty text has fingerprint zero and links like any other; ties and
repeated rows keep one result row per input row; null doc_ids are never the representative while a
non-null one exists; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, unpacked, with_row
from .textbytes import SPACE_WORD, each_block, map_rows, words
from .xxh64 import xxh64_spans

SHINGLE_WORDS = 3
MAX_BITS = 2


def block_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle_words: int) -> np.ndarray:
    """SimHash of each row of a block of lower-cased text: bit b is set when more than half of the
    row's shingle hashes have it."""
    starts, ends, first = words(data, offsets, SPACE_WORD)
    # words joined by one space each: the bytes of words and, after each word, one separator
    keep = SPACE_WORD[data]
    after = ends[ends < len(data)]
    joined = np.where(keep, data, 0x20).astype(np.uint8)
    keep[after[~keep[after]]] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    joined, starts, ends = joined[keep], place[starts], place[ends]
    # a row of fewer words than a shingle has one shingle, its whole sequence
    n = np.diff(first)
    counts = np.where(n == 0, 0, np.maximum(n - (shingle_words - 1), 1))
    begin = np.concatenate([[0], np.cumsum(counts)])
    head = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
    tail = head + np.repeat(np.minimum(n, shingle_words) - 1, counts)
    hashes = xxh64_spans(joined, starts[head], ends[tail])
    out = np.zeros(len(n), np.uint64)
    weight = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i in np.flatnonzero(counts):
        ones = np.zeros(64, np.int64)
        for a in range(begin[i], begin[i + 1], 1 << 15):
            part = hashes[a : min(a + (1 << 15), begin[i + 1])]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = weight[2 * ones > counts[i]].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, h, fp) of each row of ``docs`` (doc_id, text); h: a hash of the text, fp: signed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [block_fingerprints(data, offs, shingle_words) for _, _, data, offs in each_block(batch.column(2), lower=True)]
        fps = pa.array(np.concatenate(parts).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], names=["doc_id", "h", "fp"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("h"), "text")
    return texts.mapInArrow(map_rows(run), "doc_id long, h long, fp long")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def ball(fp: Column, radius: int) -> Column:
    """Array of all 64-bit values within ``radius`` flipped bits of ``fp``."""
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.transform(F.lit(signed).cast("array<bigint>"), lambda m: fp.bitwiseXOR(m))


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` that hold together all pairs at most
    ``max_bits`` apart: each bucket's members to its smallest, deduplicated and verified."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: the ball of half the radius decides exactly")
    emitted = distinct.select("fp", F.explode(ball(F.col("fp"), max_bits // 2)).alias("variant"))
    # a bucket holds at most the ball around its variant, so a window over it is bounded: one exchange
    met = emitted.select(F.min("fp").over(Window.partitionBy("variant")).alias("a"), F.col("fp").alias("b")).filter("a <> b")
    return (
        met.distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


def components(links: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """(node, root) of every node of ``links``; root: the component's smallest node.

    Large-star and small-star rounds: each node's larger neighbours, then each node's smaller
    ones, are tied to its smallest neighbour, until the links no longer change. Every round ends
    in checkpoint(). After large-star no node of a component keeps more links than its neighbours
    gave it, and aggregation before the join means no group is gathered in one row.
    """
    edges = cut(links.select(F.least(low, high).alias("u"), F.greatest(low, high).alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        down = large.select(F.col("v").alias("u"), F.col("u").alias("v"))  # v: smaller neighbours of u
        first = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(first, "u").select(F.col("m").alias("u"), "v").union(first.select(F.col("m").alias("u"), F.col("u").alias("v")))
        edges = cut(small.filter("u <> v").distinct())
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def _grouped(docs: DataFrame, shingle_words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows, placed): doc_id, h and fp of every row; root and first (the smallest doc_id, null last,
    with its h) of every distinct fingerprint."""
    fps = cut(fingerprints(docs, shingle_words))
    # copies are folded before the shuffle on variants; only distinct fingerprints go into it
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "h")).alias("first")
    distinct = cut(fps.groupBy("fp").agg(first))
    roots = components(fingerprint_links(distinct, max_bits))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return fps, placed


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of each row of ``docs``; component_id: the smallest doc_id
    reachable through fingerprints at most ``max_bits`` apart."""
    fps, placed = _grouped(docs, shingle_words, max_bits)
    smallest = placed.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    named = placed.join(smallest, "root").select(F.col("fp").alias("named_fp"), "component_id")
    return fps.join(named, fps.fp == named.named_fp).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of ``docs``, with all its columns: the row with the smallest doc_id
    (null last; of rows repeated under that id, the one whose text hashes smallest, and of rows with
    the same text any one)."""
    _, placed = _grouped(docs, shingle_words, max_bits)
    keys = ["no_id", "id", "h"]  # a null id is told apart from every value

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"no_id": F.col("id").isNull(), "id": F.coalesce("id", F.lit(0))})

    winners = placed.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("id"), F.col("first.h").alias("h"))
    packed = with_row(docs, F.col("doc_id").cast("long").alias("id"), text_hash().alias("h"))
    # the texts are shuffled once: repeated rows are dropped on the join's own keys
    return unpacked(keyed(packed).join(keyed(winners).distinct(), keys, "left_semi").dropDuplicates(keys), docs)
