"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    decontamination, language_id, licenses, line_dedup, manifest, packing, quality, similar_sets, spelling, substring_dedup, suffix_dedup,
    token_counts, warc,
)
from millrace.llm.frames import read_table
from millrace.llm.twins import TWINS

__all__ = ["QUERIES", "TWINS"]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents less the words of windows of 20 that start earlier elsewhere."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the robust outlier verdict of every document."""
    return quality.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def quality_base_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base statistics and rules alone."""
    found = quality.add_statistics(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.withColumn("base_failed", quality.base_failed())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, from dictionaries of the rows that aren't held out."""
    docs = read_table(spark, sf_dir, "documents")
    labelled = docs.filter(~language_id.held_out()).select("doc_id", "text", "lang")
    texts = docs.select("doc_id", language_id.held_out().alias("held_out"), "text")
    return language_id.identify(texts, language_id.fit_dictionaries(labelled)).drop("text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.add_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 0.8 of their shingles."""
    return similar_sets.link_similar(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the words that any benchmark window hits."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, read back from normalised archives."""
    archives = warc.archive_pages(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).drop("url", "payload")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds, dropped from every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents less the bytes of strings of 50 bytes that an earlier document holds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license notices of every document."""
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    places, joined = F.col("base.first"), lambda c: F.array_join(c, ",").alias(c)
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"), joined("base_labels"), joined("labels"), "score",
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their spelling variants' forms."""
    found = spelling.group_variants(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof in the manifest of all documents."""
    return manifest.prove_documents(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_packing": op1_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality": op3_quality,
    "quality_base_rules": quality_base_rules,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_licenses": op11_licenses,
    "op12_spelling": op12_spelling,
    "op13_manifest": op13_manifest,
}
