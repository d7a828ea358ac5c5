"""From raw documents to packed training sequences.

The quality classifier and the quality rules drop documents, near-duplicates leave one document of
each group, sources are mixed to their target weights, and what is left is packed. Each stage reads
the Parquet table its predecessor wrote; all but the last return the columns of ``documents``, whatever
further columns a caller's table has and whatever their names.

Defined cases: a null or empty text is rejected by the quality rules (fewer than 50 words), so no
later stage meets one; null ids are documents of their own until near-duplicates, where they never
stand for a group that has an id; rows repeated under one id and text become one row there; ties are
decided as each operator states; texts of any length go through whole; an empty table gives an empty
result at every stage.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm import mixing, packing, quality_classifier, quality_rules, simhash
from venuelens.llm.queries import tokenizer_path
from venuelens.llm.shared import on_workers, read
from venuelens.session import ensure_checkpoint_dir, remove_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones of ``sf_dir``, does not reject."""
    on_workers(spark)
    model = quality_classifier.fit_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def quality_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return simhash.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", good_quality),
    ("quality rules", quality_lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("packing", packed),
]

# Trained models and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, writing each one's table under ``spark.checkpoint.dir``; when
    the last is written, the tables between are removed."""
    docs = read(spark, sf_dir, "documents")
    root = os.path.join(ensure_checkpoint_dir(spark), "corpus_pipeline", uuid.uuid4().hex)
    for i, (_, stage) in enumerate(STAGES):
        path = os.path.join(root, str(i))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    for i in range(len(STAGES) - 1):
        remove_path(spark, os.path.join(root, str(i)))
    return docs
