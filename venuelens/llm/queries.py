"""The registered queries of the operators: each applies one to its whole table with production
parameters and returns the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    fingerprints, html_text, language_id, lexical_search, license_scan, mixing, oracles, packing, prefix_trie, quality_classifier, quality_rules,
    simhash, toxicity, warc,
)
from .shared import on_workers, read


def tokenizer_path() -> str:
    """The public vocabulary file the packing query uses."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_classifier(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_fingerprints(read(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(read(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents")).drop("copies")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.fresh_folder(spark)
    index = warc.archived_pages(read(spark, sf_dir, "pages"), folder)
    warc.removed(folder)  # the merged index is written, and all this query returns is in it
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def license_scan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op2 that SQL can follow."""
    return op2_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def document_fingerprints_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op6 that SQL can follow."""
    return op6_document_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def quality_rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9 that SQL can follow."""
    return op9_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def source_mixing_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op10 that SQL can follow."""
    return op10_source_mixing(spark, sf_dir).select("doc_id", "size", "source_size")


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _ready(q)
    for q in (
        op1_quality_classifier, op2_license_scan, op3_toxicity, op4_simhash_near_dedup, op5_packing, op6_document_fingerprints,
        op7_html_extraction, op8_language_id, op9_quality_rules, op10_source_mixing, op11_lexical_search,
        op12_conversation_prefix_trie, op13_warc,
        license_scan_base, document_fingerprints_edited, quality_rules_base, source_mixing_sizes,
    )
}

# DuckDB SQL where it can express a whole query; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op11_lexical_search": oracles.LEXICAL_SEARCH,
    "op12_conversation_prefix_trie": oracles.PREFIX_TRIE,
    "op13_warc": oracles.WARC,
    "license_scan_base": oracles.LICENSE_BASE,
    "document_fingerprints_edited": oracles.EDITED_TEXTS,
    "quality_rules_base": oracles.QUALITY_BASE,
    "source_mixing_sizes": oracles.MIXTURE_SIZES,
}
