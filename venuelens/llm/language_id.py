"""Language identification by language-bitmask n-gram filters.

Training keeps, for each language, the letter n-grams (four bytes, word edges included) that make
up at least ``MIN_SHARE`` of its n-grams, hence at most 1 / MIN_SHARE of them, and all of them where
a language has fewer in all. They fill one
bit-sliced Bloom filter: every cell is a mask with one bit per language, so looking up an n-gram is
an AND of its cells and returns all languages that contain it at once. A text's n-grams are counted
per language bit; each count is corrected for the filter's false positives, and the largest decides.

Training reads a bounded sample of documents per language (``docs_per_language``, drawn in a fixed
hash order); n-gram counts are summed by Spark, and only the n-grams kept come to the driver.
Prediction needs no shuffle.

Defined cases: a null text, or one with no letter, is ``und`` with score 0; a text with letters but
no known n-gram gets the language with the most training text, score 0; ties go to the language
that sorts first; repeated rows get equal results, each its own row; with no training rows all
predictions are ``und``; an empty table gives an empty result; other columns are not read. Languages
are sorted by code point; masks hold as many as there are, in 64-bit words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import fold
from .textbytes import LOWER, each_block

DOCS_PER_LANGUAGE = 3_000
MIN_SHARE = 1e-5
GRAM = 4
CELLS = 1 << 20  # a power of two
PARTS, HELD = 4, 2

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = True
_ASCII_LETTER[0x61:0x7B] = True


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, first): four letters, or up to three with a word edge before, after or on both sides
    of them, of each row. Every row is taken as if it began and ended at a word edge."""
    if len(data) == 0:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    # one blank between rows, so that no window reaches into the next one
    n = len(offsets) - 1
    text = np.full(len(data) + n + 2, 0x20, np.uint8)
    clean = LOWER[data]
    text[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets)) + 1] = np.where(_LETTER[clean], clean, 0x20)
    starts = offsets[:-1] + np.arange(n)
    letter = text != 0x20
    alone = letter[1:-2] & ~letter[:-3] & ~letter[2:-1] if len(text) > 3 else np.zeros(0, bool)  # a word of one letter
    inner = letter[1:-2] & letter[2:-1] if len(text) > 3 else alone
    at = np.flatnonzero(inner | alone)
    wide = text.astype(np.uint32)
    last = np.where(alone[at], np.uint32(0x20), wide[at + 3])
    packed = (wide[at] << np.uint32(24)) | (wide[at + 1] << np.uint32(16)) | (wide[at + 2] << np.uint32(8)) | last
    return packed, np.searchsorted(at, np.concatenate([starts, [len(text)]]), "left")


def cells_of(packed: np.ndarray) -> list[np.ndarray]:
    """The two cells of each n-gram."""
    bits = np.uint64(CELLS.bit_length() - 1)
    mixed = packed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    again = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return [(mixed >> (np.uint64(64) - bits)).astype(np.int64), (again >> (np.uint64(64) - bits)).astype(np.int64)]


@dataclass
class Filters:
    languages: list[str]
    masks: np.ndarray  # (cells, words): bit l % 64 of word l // 64 is language l
    false_rate: np.ndarray  # chance that an n-gram of no training text passes, per language
    default: int

    def counts(self, packed: np.ndarray, first: np.ndarray) -> np.ndarray:
        """n-grams of each row that each language contains, false positives included."""
        a, b = cells_of(packed)
        out = np.zeros((len(first) - 1, len(self.languages)))
        for word in range(self.masks.shape[1]):
            mask = self.masks[a, word] & self.masks[b, word]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                run = np.concatenate([[0], np.cumsum((mask >> mask.dtype.type(bit)) & mask.dtype.type(1), dtype=np.int64)])
                out[:, 64 * word + bit] = run[first[1:]] - run[first[:-1]]
        return out

    def decide(self, packed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(first)[:, None]
        clean = np.maximum((self.counts(packed, first) - n * self.false_rate) / (1 - self.false_rate), 0)
        total = clean.sum(axis=1)
        best = np.where(total > 0, clean.argmax(axis=1), self.default)
        score = clean[np.arange(len(best)), best] / np.maximum(total, 1e-12)
        return best, np.where(total > 0, np.clip(score, 0, 1), 0.0)


def build(languages: list[str], lang: np.ndarray, packed: np.ndarray, default: int) -> Filters:
    """The bit-sliced filter of (language, n-gram) pairs."""
    small = np.uint8 if len(languages) <= 8 else np.uint64
    masks = np.zeros((CELLS, max(1, -(-len(languages) // 64))), small)
    for cell in cells_of(packed):
        np.bitwise_or.at(masks, (cell, lang // 64), small(1) << (lang % 64).astype(small))
    fill = np.array([((masks[:, l // 64] >> small(l % 64)) & small(1)).mean() for l in range(len(languages))])
    return Filters(languages, masks, fill**2, default)


def fit_language(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, min_share: float = MIN_SHARE) -> Filters | None:
    """Filters of every non-null ``lang`` of the documents outside the held fold."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", PARTS) != HELD))
    ids = known.select("doc_id", "lang").distinct()  # an id may be repeated; its texts then count once each
    sizes = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    # the first ids in hash order are wanted; hashes above four times the expected place of the last
    # one are left out beforehand, so that a hot language brings few rows to its window
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    reach = F.create_map(*[F.lit(x) for l, n in sizes.items() for x in (l, min(1.0, 4 * docs_per_language / n))])
    turn = Window.partitionBy("lang").orderBy("place", "doc_id")
    drawn = (
        ids.withColumn("place", place).filter(F.col("place") <= reach[F.col("lang")])
        .withColumn("__n", F.row_number().over(turn)).filter(F.col("__n") <= docs_per_language)
        .select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"))
    )
    texts = known.select("doc_id", "lang", "text")
    sample = texts.join(F.broadcast(drawn), (texts.doc_id == drawn["__id"]) & (texts.lang == drawn["__lang"])).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            code, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
            for a, b, data, offs in each_block(batch.column(1)):
                packed, first = grams(data, offs)
                owner = np.repeat(code[a:b].astype(np.uint64), np.diff(first))
                pairs, n = np.unique((owner << np.uint64(32)) | packed, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in (pairs >> np.uint64(32)).tolist()], pa.string()),
                     pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    counts = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the total of a language over its n-grams: a second aggregation, so no language is one task's window
    counts = counts.persist()
    try:
        totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
        if not totals:
            return None
        languages = sorted(totals)
        floor = F.create_map(*[F.lit(x) for l in languages for x in (l, min_share * totals[l])])
        kept = counts.filter(F.col("n") >= floor[F.col("lang")]).select("lang", "gram").toArrow()
    finally:
        counts.unpersist()
    index = {l: i for i, l in enumerate(languages)}
    lang = np.array([index[l] for l in kept.column("lang").to_pylist()], np.int64)
    default = max(range(len(languages)), key=lambda i: (totals[languages[i]], -i))
    return build(languages, lang, kept.column("gram").to_numpy().astype(np.uint32), default)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = run[offsets[1:]] > run[offsets[:-1]]
    wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
    for i in np.flatnonzero(~found & (wide[offsets[1:]] > wide[offsets[:-1]])):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def language_scores(docs: DataFrame, filters: Filters | None) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names, scores = [], []
            for a, b, data, offs in each_block(batch.column(1)):
                letters = _has_letter(data, offs) if model else np.zeros(b - a, bool)
                best, score = model.decide(*grams(data, offs)) if model else (np.zeros(b - a, int), np.zeros(b - a))
                names += [model.languages[i] if ok else "und" for i, ok in zip(best.tolist(), letters, strict=True)]
                scores.append(np.where(letters, score, 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of ``docs``."""
    return language_scores(docs, fit_language(docs, docs_per_language)).select(
        "doc_id", F.coalesce(fold("doc_id", PARTS) == HELD, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
