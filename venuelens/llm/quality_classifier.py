"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics (size, word and line shape, character classes, repetition) are computed over whole
texts in vectorised blocks; the trees are fitted on a bounded sample of labelled documents
(``sample_rows``, by default 20,000 ids in a fixed hash order) and broadcast; scoring needs no
shuffle.

Defined cases: a null or empty text has the statistics of no words and is scored like any other;
ties do not arise; repeated rows get equal scores, each its own row; with no labelled rows every
score is 0.5; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .shared import filtered, labelled_sample, with_fold
from .textbytes import (
    CODE_POINT, SPACE_WORD, each_block, gram_hashes, histograms, map_rows, repeated_in_row, rows_of, span_hashes, sums, words,
)

SAMPLE_ROWS = 20_000
PARTS, HELD, THRESHOLD = 3, 1, 0.5


def _bytes(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _bytes("abcdefghijklmnopqrstuvwxyz")
_CLASSES = np.column_stack([
    CODE_POINT, _UPPER, _LOWER, np.arange(256) >= 0x80, _bytes("0123456789"), _bytes("#*$%&|<>~^=+_@\\"),
    _bytes(".,;:"), _bytes("!?"), _bytes("|"), _bytes(" \t\n\r"), _bytes("\n"), _bytes("{}[]()/\"'"),
]).astype(np.int64)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Feature matrix (rows, features) of a block of texts."""
    points, upper, lower, wide, digits, symbols, marks, bangs, pipes, blanks, breaks, brackets = (
        histograms(data, offsets) @ _CLASSES
    ).T.astype(float)
    starts, ends, first = words(data, offsets, SPACE_WORD)
    n = np.diff(first).astype(float)
    rows = rows_of(first)
    hashes = span_hashes(data, starts, ends)
    twice, later = repeated_in_row(hashes, rows)
    grams, gram_first = gram_hashes(hashes, first, 3)
    gram_twice, gram_later = repeated_in_row(grams, rows_of(gram_first))
    size = (ends - starts).astype(float)
    chars, count, letters = np.maximum(points, 1), np.maximum(n, 1), np.maximum(upper + lower + wide, 1)
    grams_n = np.maximum(np.diff(gram_first), 1)
    total = sums(size, first)
    spread = sums(size * size, first) / count - (total / count) ** 2
    return np.column_stack([
        np.log1p(points), np.log1p(n), total / count, np.sqrt(np.maximum(spread, 0)),
        symbols / chars, upper / letters, digits / chars, marks / chars, bangs / chars, pipes / chars, brackets / chars,
        blanks / chars, wide / letters, breaks / count, n / (breaks + 1),
        sums(later.astype(float), first) / count, sums(twice.astype(float), first) / count,
        sums(gram_later.astype(float), gram_first) / grams_n, sums(gram_twice.astype(float), gram_first) / grams_n,
        sums((size <= 1).astype(float), first) / count, sums((size >= 16).astype(float), first) / count,
        symbols / count, bangs / count, upper / count,
    ])


def _all(column: pa.Array) -> np.ndarray:
    return np.concatenate([statistics(data, offs) for _, _, data, offs in each_block(column)])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> boosting.Trees:
    """Trees fitted on the statistics of the bounded sample, which only numbers leave the tasks for."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _all(batch.column(1))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), lists], names=["doc_id", "label", "x"])

    sample = labelled_sample(docs, labels, label, PARTS, HELD, sample_rows)
    rows = (
        sample.mapInArrow(map_rows(run), "doc_id long, label double, x array<double>")
        .groupBy("doc_id", "label")
        .agg(F.min("x").alias("x"))  # rows repeated under one id teach once
        .orderBy("doc_id")
        .toArrow()
    )
    n = rows.num_rows
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
    return boosting.fit(x, rows.column("label").to_numpy())


def _scores(column: pa.Array, model: boosting.Trees) -> np.ndarray:
    return model.probability(_all(column))


def quality_scores(docs: DataFrame, model: boosting.Trees) -> DataFrame:
    """(doc_id, score) of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = _scores(batch.column(1), shared.value)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(score)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(map_rows(run), "doc_id long, score double")


def quality_classifier(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``."""
    return with_fold(quality_scores(docs, fit_quality(docs, labels, sample_rows=sample_rows)), PARTS, HELD, THRESHOLD)


def keep_good(docs: DataFrame, model: boosting.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored at least ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, lambda column: _scores(column, shared.value) >= threshold)
