"""The corpus pipeline: five stages over documents, each on what the one before it kept.

Every function takes (spark, docs, sf_dir) and returns a frame; all but the last return the
columns of documents. Stage functions read docs from a table: `run` writes each stage's rows to
the shared folder and reads them again. Further columns of docs are left out, texts have any length,
and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontamination, language_id, line_dedup, packing, similar_sets
from millrace.llm.frames import read_table
from millrace.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin. Dictionaries come from the labelled rows
    that aren't held out. Null, empty and letterless texts go; nulls elsewhere don't matter, and
    repeated rows stay or go together. Rows of which none is labelled and not held out raise a
    ValueError, since nothing could be told; an empty table gives an empty table."""
    labelled = docs.filter(~language_id.held_out()).select("doc_id", "text", "lang")
    dictionaries = language_id.fit_dictionaries(labelled)
    if not dictionaries and not docs.isEmpty():
        raise ValueError("no labelled row to learn a language from")
    found = language_id.identify(docs.select(*COLUMNS), dictionaries)
    return found.filter("accepted").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that an earlier one holds; those left without a word go, null and
    empty texts among them. Rows without a doc_id lose no line and take none; rows that share one
    lose none to each other. n_chars is that of the text that is left."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return (
        kept.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*COLUMNS)
    )


def keep_first_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the smallest doc_id, with all rows that share it.
    Rows without a doc_id, which belong to no group, stay, and so do texts without a word."""
    groups = similar_sets.link_similar(docs).distinct()
    others = groups.filter("doc_id <> component_id").select("doc_id")
    return docs.join(others, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window. A null text has none; rows are judged one by one."""
    found = decontamination.find_contamination(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))
    return found.filter("n_hit = 0").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids. A null text is its end id alone; every row,
    repeated or without a doc_id, is packed."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_identified),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_first_similar),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: the language stage compresses and the last stage tokenises, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    rows = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        rows = stage(function(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
