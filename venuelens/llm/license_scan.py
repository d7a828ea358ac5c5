"""License scans by diagonal voting.

Every rolling word k-gram hash of every text is joined (broadcast: the template table is a fixed
list) to the template positions with that hash. A joined gram is verified word by word, then votes
for the diagonal ``position in the text - position in the template``. Votes are counted per
diagonal, neighbouring diagonals of a template are merged (a word too many or too few shifts the
rest of a passage by one), and a merged span is accepted by the share of the template that it
covers. Short phrases must be covered in full on one diagonal, i.e. stand there word for word.

Defined cases: a null or empty text has no words and no labels, score 0; overlapping and repeated
places all count; repeated rows are scanned each for itself (rows are told apart by their place in
the scan, not by doc_id); null doc_ids stay null; very long texts are cut in no place; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .textbytes import ALNUM_WORD, each_block, gram_hashes, rows_of, span_hashes, words

# Phrases that must stand word for word, and their labels.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Wording of published licenses, matched in part.
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("cc-by", "you are free to share copy and redistribute the material in any medium or format and adapt remix transform and build upon the material for any purpose even commercially you must give appropriate credit provide a link to the license and indicate if changes were made"),
]
SHORT_GRAM, LONG_GRAM = 2, 5
MIN_COVERAGE = 0.6
MAX_SHIFT = 3  # words by which neighbouring diagonals may differ


def _hashes(texts: list[str], k: int) -> tuple[list[int], np.ndarray]:
    """Signed k-gram hashes of all texts, and the index of each text's first."""
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts, ends, first = words(data, offsets, ALNUM_WORD)
    got, begin = gram_hashes(span_hashes(data, starts, ends), first, k)
    return got.view(np.int64).tolist(), begin


def template_positions(k: int, templates: list[tuple[str, str]], base: bool) -> list[tuple]:
    """(hash, template, tpos, gram text, label, base, grams of the template) of every position."""
    hashes, begin = _hashes([t for _, t in templates], k)
    out = []
    for i, (label, text) in enumerate(templates):
        tokens, n = text.split(), int(begin[i + 1] - begin[i])
        for p in range(n):
            out.append((hashes[begin[i] + p], ("p" if base else "t") + str(i), p, " ".join(tokens[p : p + k]), label, base, n))
    return out


def _positions_frame(spark: SparkSession, rows: list[tuple], name: str) -> DataFrame:
    schema = f"{name} long, template string, tpos int, gram string, label string, base boolean, n_grams int"
    return (
        spark.createDataFrame(rows, schema)
        .groupBy(name)
        .agg(F.collect_list(F.struct("template", "tpos", "gram", "label", "base", "n_grams")).alias(f"at_{name}"))
    )


def _strings(data: bytes, spans: list[tuple[int, list[tuple[int, int]]]], n: int) -> pa.Array:
    """A string column of ``n`` rows, empty but for the given rows, whose words are joined."""
    texts = [b" ".join(data[a:b] for a, b in parts) for _, parts in spans]
    sizes = np.zeros(n + 1, np.int32)
    sizes[[i + 1 for i, _ in spans]] = [len(t) for t in texts]
    return pa.StringArray.from_buffers(n, pa.py_buffer(np.cumsum(sizes, dtype=np.int32)), pa.py_buffer(b"".join(texts)))


GRAM_SCHEMA = "key long, doc_id long, n_words long, pos int, h2 long, h5 long, gram string"


def rolling_grams(docs: DataFrame, short: list[int], long: list[int]) -> DataFrame:
    """One row per word position: the hashes of the grams that begin there (null past the last),
    and one row per text with pos -1, its id and word count. ``gram`` holds the words at positions
    whose hash agrees with a template's in the low bits, for verification."""
    low2, low5 = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
    low2[np.array(short, np.int64).view(np.uint64) & np.uint64(0xFFFF)] = True
    low5[np.array(long, np.int64).view(np.uint64) & np.uint64(0xFFFF)] = True
    schema = pa.schema([
        ("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("pos", pa.int32()),
        ("h2", pa.int64()), ("h5", pa.int64()), ("gram", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for a, b, data, offs in each_block(batch.column(1), lower=True):
                starts, ends, first = words(data, offs, ALNUM_WORD)
                rows, n, total = rows_of(first), np.diff(first), len(starts)
                hashes = span_hashes(data, starts, ends)
                pos = np.arange(total) - np.repeat(first[:-1], n)
                left = np.repeat(n, n) - pos  # words from here to the end of the text
                columns, wanted = [], np.zeros(total, bool)
                for k, low in ((SHORT_GRAM, low2), (LONG_GRAM, low5)):
                    got, _ = gram_hashes(hashes, first, k)
                    full, there = np.zeros(total, np.uint64), left >= k
                    full[there] = got
                    wanted |= there & low[full & np.uint64(0xFFFF)]
                    columns.append(pa.array(full.view(np.int64), mask=~there))
                raw = data.tobytes()
                spans = [
                    (i, list(zip(starts[i : i + m].tolist(), ends[i : i + m].tolist(), strict=True)))
                    for i, m in ((int(i), int(min(LONG_GRAM, left[i]))) for i in np.flatnonzero(wanted))
                ]
                none = pa.nulls(total, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key + rows), none, none, pa.array(pos.astype(np.int32)), *columns, _strings(raw, spans, total)],
                    schema=schema,
                )
                m = b - a
                none = pa.nulls(m, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key + np.arange(m)), ids.slice(a, m), pa.array(n.astype(np.int64)),
                     pa.array(np.full(m, -1, np.int32)), none, none, pa.nulls(m, pa.string())],
                    schema=schema,
                )
                key += m

    return docs.select("doc_id", "text").mapInArrow(run, GRAM_SCHEMA)


def license_votes(docs: DataFrame, phrases: list = PHRASES, texts: list = TEXTS) -> DataFrame:
    """Verified votes per (key, template, diagonal), and one row with a null template per text that
    carries doc_id and n_words. ``key`` tells rows of ``docs`` apart."""
    spark = docs.sparkSession
    short = template_positions(SHORT_GRAM, phrases, True)
    long = template_positions(LONG_GRAM, texts, False)
    grams = rolling_grams(docs, [r[0] for r in short], [r[0] for r in long])
    met = (
        grams.join(F.broadcast(_positions_frame(spark, short, "h2")), "h2", "left")
        .join(F.broadcast(_positions_frame(spark, long, "h5")), "h5", "left")
        .filter((F.col("pos") == -1) | F.col("at_h2").isNotNull() | F.col("at_h5").isNotNull())
    )
    none = F.array().cast("array<struct<template:string,tpos:int,gram:string,label:string,base:boolean,n_grams:int>>")
    hits = met.select(
        "key", "doc_id", "n_words", "pos", "gram",
        F.explode_outer(F.concat(F.coalesce("at_h2", none), F.coalesce("at_h5", none))).alias("at"),
    ).filter(
        F.col("at").isNull()
        | F.when(F.col("at.base"), F.substring_index("gram", " ", SHORT_GRAM)).otherwise(F.col("gram")).eqNullSafe(F.col("at.gram"))
    )
    return (
        hits.repartition("key")  # every step below is within a text
        .groupBy("key", F.col("at.template").alias("template"), (F.col("pos") - F.col("at.tpos")).alias("diagonal"))
        .agg(
            F.first("at.label").alias("label"), F.first("at.base").alias("base"), F.first("at.n_grams").alias("n_grams"),
            F.count("at").alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high"),
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        )
    )


def license_spans(docs: DataFrame, phrases: list = PHRASES, texts: list = TEXTS, max_shift: int = MAX_SHIFT) -> DataFrame:
    """One row per span (key, template, label, base, start, end in words, coverage 0..1), and the
    row with a null template per text."""
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    # phrases are matched on one diagonal; of longer texts, diagonals up to max_shift apart merge
    fresh = F.col("base") | F.lag("diagonal").over(along).isNull() | (F.col("diagonal") - F.lag("diagonal").over(along) > max_shift)
    merged = (
        license_votes(docs, phrases, texts)
        .withColumn("fresh", F.when(fresh, 1).otherwise(0))
        .withColumn("span", F.sum("fresh").over(along))
        .groupBy("key", "template", "span")
        .agg(
            F.first("label").alias("label"), F.first("base").alias("base"), F.min("low").alias("start"),
            F.max(F.col("high") + F.when(F.col("base"), SHORT_GRAM).otherwise(LONG_GRAM)).alias("end"),
            F.least(F.sum("votes") / F.first("n_grams"), F.lit(1.0)).alias("coverage"),
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        )
    )
    return merged.select("key", "doc_id", "n_words", "template", "label", "base", "start", "end", "coverage")


def license_scan(docs: DataFrame, min_coverage: float = MIN_COVERAGE, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base and first_word / last_word (places of the
    phrases), base_labels, labels (phrases and texts, sorted and comma-joined), score (the largest
    coverage) and n_spans (accepted spans of texts)."""
    place = F.col("base") & (F.col("coverage") >= 1)
    span = ~F.col("base") & (F.col("coverage") >= min_coverage)
    joined = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    return (
        license_spans(docs, **options)
        .groupBy("key")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.count(F.when(place, 1)).alias("n_base"),
            F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"),
            joined(place).alias("base_labels"),
            joined(place | span).alias("labels"),
            # a part of a phrase is no evidence, e.g. "public license" alone
            F.coalesce(F.max(F.when(place | ~F.col("base"), F.col("coverage"))), F.lit(0.0)).alias("score"),
            F.count(F.when(span, 1)).alias("n_spans"),
        )
        .drop("key")
    )
