"""Ranked lexical search, term at a time with limited accumulators.

Two passes over the texts. The first counts, for the terms the items ask for, the documents that
hold them, and the sizes of the collection. The second turns runs of documents into small inverted
lists, one shard at a time, and ranks every item on them: its terms rarest first, each adding its
integer contribution to an accumulator a document. A new accumulator is created only while the
largest contributions still to come could lift an unseen document to the kth partial score; after
that the lists only update the documents that already have one, exactly. The kth score of the
shards before, known to the same task, serves as a floor. A window merges the shards' best.

The work of a task is bounded by its shard, whatever a term's frequency: no list of a term leaves
its task, and only k rows an item and task are shuffled. Items are taken in blocks of a stated
number of terms, each block searched against all documents, so that what goes to the workers is
bounded however many items there are.

Defined cases: a null text has no term; an empty one neither; a text of any length is counted
whole, in windows; equal scores rank by ascending id, null ids last; repeated document rows are
ranked each for itself; rows of one item id are one item with the terms of all of them, and a null
item id is an item too; items without a term, or without a document that scores above 0, give no
row; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut
from .textbytes import ALNUM_WORD, SpanHasher, each_window, span_hashes, words

K = 10
BLOCK_TERMS = 200_000  # (item, term) pairs searched in one go
SHARD = 1_000_000  # postings held at once by a task
MERGE = 64  # first-step groups an item's partial rankings are merged in

# The terms of the contract and the constants of its score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LENGTH_SHARE = 90  # percent of a document's length that counts against it
SATURATION = 8


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, terms): the distinct terms of each item id, in ascending order."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(TERM), F.lit(0))
    pairs = items.select(F.col(item_id).alias("item"), F.explode(found).alias("term")).distinct()
    return pairs.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))


class Vocabulary:
    """The terms of a block of items, found in text buffers by hash and then byte by byte."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        self.lengths = np.array([len(r) for r in raw], np.int64)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(self.lengths)
        self.starts = ends - self.lengths
        hashes = span_hashes(self.data, self.starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, term): which of the words are terms, and which ones."""
        if not len(starts) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = SpanHasher(data)(starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        word = np.flatnonzero(self.hashes[at] == h)
        term = self.order[at[word]]
        same = self.lengths[term] == ends[word] - starts[word]
        word, term = word[same], term[same]
        if len(word):
            size = self.lengths[term]
            first = np.cumsum(size) - size
            step = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
            equal = data[np.repeat(starts[word], size) + step] == self.data[np.repeat(self.starts[term], size) + step]
            whole = np.logical_and.reduceat(equal, first)
            word, term = word[whole], term[whole]
        return word, term


def postings(column: pa.Array, terms: Vocabulary) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, terms in all of each row, and by row and term: row, term, tf) of runs of rows."""
    row0, n, open_pairs = None, None, []

    def closed():
        row, term, tf = (np.concatenate(x) for x in zip(*open_pairs, strict=True))
        if len(open_pairs) > 1:
            key, at = np.unique(row * len(terms.hashes) + term, return_inverse=True)
            tf = np.bincount(at, tf).astype(np.int64)
            row, term = np.divmod(key, len(terms.hashes))
        return row0, n, row, term, tf

    for a, b, data, offs in each_window(column, ALNUM_WORD, lower=True):
        starts, ends, first = words(data, offs, ALNUM_WORD)
        word, term = terms.find(data, starts, ends)
        row = np.searchsorted(first, word, "right") - 1
        key, tf = np.unique(row * max(len(terms.hashes), 1) + term, return_counts=True)
        row, term = np.divmod(key, max(len(terms.hashes), 1))
        if row0 is not None and (a != row0 or b - a > 1):
            yield closed()
            open_pairs, n = [], None
        row0 = a
        n = np.diff(first) if n is None else n + np.diff(first)
        open_pairs.append((row, term, tf.astype(np.int64)))
    if row0 is not None:
        yield closed()


def statistics(docs: DataFrame, terms: list[str], text: str = "text") -> tuple[int, int, np.ndarray]:
    """(documents with a term, all terms with repeats, documents by term) over all of ``docs``."""
    vocabulary = Vocabulary(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms) + 2, np.int64)
        for batch in batches:
            for _, n, _, term, _ in postings(batch.column(0), vocabulary):
                counts[0] += np.count_nonzero(n)
                counts[1] += n.sum()
                counts[2:] += np.bincount(term, minlength=len(terms))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    sums = docs.select(text).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(len(terms) + 2, np.int64)
    total[[r.at for r in sums]] = [r.n for r in sums]
    return int(total[0]), int(total[1]), total[2:]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class Ranking:
    """The best ``k`` (score, id) of one item so far; equal scores by ascending id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        if len(score) > self.k:  # ties with the kth stay in
            high = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids, null = score[high], ids[high], null[high]
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        best = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.id, self.null = score[best], ids[best], null[best]


class Shard:
    """Inverted lists of some documents and their exact contributions."""

    def __init__(self, ids, null, n, row, term, tf, n_terms: int, collection: tuple[int, int], weight: np.ndarray):
        self.ids, self.null = ids, null
        n_docs, length = collection
        if len(n) and int(n.max()) * n_docs * LENGTH_SHARE >= 2**62:
            m = np.array([LENGTH_SHARE * int(x) * n_docs // length for x in n], np.int64)
        else:
            m = LENGTH_SHARE * n * n_docs // max(length, 1)
        m += 100 - LENGTH_SHARE
        order = np.argsort(term, kind="stable")
        self.row, term, tf = row[order], term[order], tf[order]
        self.part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * m[self.row]))
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, np.int64)  # the bound of each term: its largest contribution here
        held = np.flatnonzero(np.diff(self.first))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.part, self.first[held])
        self.sum = np.zeros(len(ids), np.int64)

    def rank(self, terms: np.ndarray, best: Ranking) -> int:
        """Add this shard's documents to ``best`` for an item whose ``terms`` come rarest first;
        the number of accumulators it took."""
        left = np.cumsum(self.most[terms][::-1])[::-1]  # what the lists from here on can add at most
        kth, opening, held = best.floor, True, np.zeros(0, np.int64)
        has = np.zeros(len(self.ids), bool)
        for t, bound in zip(terms.tolist(), left.tolist(), strict=True):
            if bound == 0:
                break
            if opening and len(held) >= best.k:
                scores = self.sum[held]
                kth = max(kth, int(np.partition(scores, len(held) - best.k)[len(held) - best.k]))
            opening = opening and bound >= kth  # an equal score may still win by its id
            row, part = self.row[self.first[t] : self.first[t + 1]], self.part[self.first[t] : self.first[t + 1]]
            if opening:
                held = np.concatenate([held, row[~has[row]]])
                has[row] = True
            else:
                keep = has[row]
                row, part = row[keep], part[keep]
            self.sum[row] += part  # a document stands once in a term's list
        good = held[(self.sum[held] > 0) & (self.sum[held] >= best.floor)]
        best.add(self.sum[good], self.ids[good], self.null[good])
        self.sum[held] = 0
        return len(held)


def _search_block(docs: DataFrame, block: list, doc_id: str, text: str, k: int, shard: int) -> DataFrame:
    """(at, doc_id, score): each task's best documents of each item of ``block``, by its place."""
    terms = sorted({t for _, found in block for t in found})
    number = {t: i for i, t in enumerate(terms)}
    n_docs, length, df = statistics(docs, terms, text)
    weight = weights(n_docs, df)
    asked = []
    for _, found in block:
        at = np.array([number[t] for t in found], np.int64)
        asked.append(at[np.argsort(df[at], kind="stable")])  # rarest first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, best = Vocabulary(terms), [Ranking(k) for _ in asked]
        waiting, n_rows, n_postings = [], 0, 0

        def flush():
            ids, null, n, row, term, tf = (np.concatenate(x) for x in zip(*waiting, strict=True))
            lists = Shard(ids, null, n, row, term, tf, len(terms), (n_docs, length), weight)
            for wanted, found in zip(asked, best, strict=True):
                lists.rank(wanted, found)

        for batch in batches:
            column = batch.column(0).cast(pa.int64())
            nulls = column.is_null().to_numpy(zero_copy_only=False)
            numbers = column.fill_null(0).to_numpy()
            for a, n, row, term, tf in postings(batch.column(1), vocabulary):
                waiting.append((numbers[a : a + len(n)], nulls[a : a + len(n)], n, row + n_rows, term, tf))
                n_rows += len(n)
                n_postings += len(row) + len(n)
                if n_postings >= shard:
                    flush()
                    waiting, n_rows, n_postings = [], 0, 0
        if waiting:
            flush()
        for at, found in enumerate(best):
            if len(found.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found.score), at)), pa.array(found.id, mask=found.null), pa.array(found.score)],
                    names=["at", "doc_id", "score"],
                )

    return docs.select(doc_id, text).mapInArrow(run, "at long, doc_id long, score long")


def _best(found: DataFrame, k: int, *group: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_terms: int = BLOCK_TERMS, shard: int = SHARD,
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Items go to the workers in blocks of at most ``block_terms`` terms (an item with more is a block
    of its own); a block's result, k rows an item, is written before the next is searched.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    asked = cut(item_terms(items, item_id, item_text))
    results, block, size = [], [], 0

    def searched():
        found = _search_block(docs, block, doc_id, text, k, shard)
        # every task may bring k rows an item: merged in two steps, none of which meets all of them
        near = _best(found.withColumn("some", F.spark_partition_id() % MERGE), k, "at", "some")
        best = _best(near.drop("rank", "some"), k, "at")
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"at long, item {kind}")
        return cut(best.join(F.broadcast(names), "at").select(F.col("item").alias("item_id"), "rank", "doc_id", "score"))

    for row in asked.toLocalIterator():
        if block and size + len(row.terms) > block_terms:
            results.append(searched())
            block, size = [], 0
        block.append((row.item, row.terms))
        size += len(row.terms)
    if block:
        results.append(searched())
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionAll(r)
    return out
