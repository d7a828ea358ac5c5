"""Session helpers of the operators: tables in the shared folder, fold columns, bounded samples."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the folder of ``spark.checkpoint.dir``, lineage cut there.

    Reliable checkpoints outlive lost executors, and Spark's cleaner removes them when the frame
    is no longer referenced (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)  # a folder of our own only where none is configured
    return df.checkpoint(eager=True)


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids get null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int = 7) -> DataFrame:
    """At most ``rows`` rows in a fixed pseudo-random order of ``key``: the same rows at each run,
    however the table is partitioned.

    Hashes above four times the expected place of the last row wanted (and some more, for small
    samples) are left out beforehand, so that the rows that meet in the sort are bounded by the sample.
    """
    place = F.xxhash64(F.col(key), F.lit(seed))
    share = (4 * rows + 256) / max(df.count(), 1)
    near = df if share >= 1 else df.filter(place <= -(1 << 63) + int(share * 2**64))
    return near.orderBy(place, key).limit(rows)


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this checkout where it lies at the same path (local sessions,
    shared folders); elsewhere the package is installed or given by ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([*have, root])


def known_labels(labels: DataFrame, label: str, parts: int, held: int) -> DataFrame:
    """(doc_id, __label) of each labelled id whose fold is not ``held``; an id with several labels
    takes the largest, null labels and null ids are left out."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", parts) != held))
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("__label"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled ids whose fold is not ``held``.

    The ids are drawn in a fixed hash order from the small label table and broadcast (bounded by
    ``rows``) to one scan of the texts. An id with several labels takes the largest; null labels
    and null ids teach nothing.
    """
    known = known_labels(labels, label, parts, held)
    drawn = bounded_sample(known, "doc_id", rows).withColumnRenamed("doc_id", "__id")
    texts = docs.select("doc_id", "text")
    return texts.join(F.broadcast(drawn), texts.doc_id == drawn["__id"]).select("doc_id", "text", F.col("__label").alias("label"))


def with_fold(scored: DataFrame, parts: int, held: int, threshold: float) -> DataFrame:
    """``scored`` (doc_id, score) with held_out (false for null ids) and predicted."""
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", parts) == held, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


HOT_KEYS = 1_000


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], counts: DataFrame, total: int) -> DataFrame:
    """``rows`` left-joined with ``table`` (one row per key) on ``keys``, whatever a key's share.

    ``counts`` (keys, n) holds the number of ``rows`` of a key. Keys with over a thousandth of all
    ``total`` rows, of which there can be a thousand at most, are broadcast; their rows are dealt by
    a hash of the row in the shuffled join, which finds the rest.
    """
    values = [c for c in table.columns if c not in keys]
    hot = table.join(counts.filter(F.col("n") * HOT_KEYS > total).select(*keys), keys, "left_semi")
    near = rows.join(F.broadcast(hot.select(*keys, F.struct(*values).alias("__hot"))), keys, "left")
    spread = F.when(F.col("__hot").isNotNull(), F.xxhash64(*[F.col(c) for c in rows.columns if c not in keys])).otherwise(0)
    far = table.select(*keys, F.lit(0).cast("long").alias("__spread"), F.struct(*values).alias("__cold"))
    joined = near.withColumn("__spread", spread).join(far, [*keys, "__spread"], "left")
    found = F.coalesce("__hot", "__cold")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in values])


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def with_row(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The named columns and, as the struct ``row``, all of each row: an operator's own columns stand
    beside it, so that no name of a user's column can clash with them."""
    return docs.select(*columns, F.struct(*[_named(c) for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows that ``with_row`` packed, with the columns of ``docs``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def filtered(docs: DataFrame, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose text ``keep`` (from a column of texts to booleans) marks, all columns
    unchanged, whatever their names and types."""
    packed = with_row(docs)  # the text is read where it lies in the row, not sent twice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column("row").field("text"))))

    return unpacked(packed.mapInArrow(run, packed.schema), docs)
