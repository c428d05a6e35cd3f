"""Rows that share a doc_id, as one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import stage


def content_digest() -> Column:
    return F.md5(F.col("text").cast("binary"))


def one_document_each(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(documents, places) for rows (doc_id, text).

    documents: (doc_id, text) with no two different texts under one doc_id. Where rows have several, the
    document is all of them, in byte order, with a word between two that no other document holds (a NUL,
    a digest of the doc_id and the text's number, a NUL, between blanks). places: (doc_id, digest,
    before) of these rows, `before` being the text in front of the row's own; None if there are none.
    """
    contents = texts.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("own"))
    ends = contents.groupBy("doc_id").agg(F.min("own").alias("low"), F.max("own").alias("high"))
    several = stage(ends.filter("low <> high").select("doc_id"), "several-texts")
    if several.isEmpty():
        return texts, None
    held = texts.join(several, "doc_id").filter("text is not null").groupBy("doc_id").agg(F.array_sort(F.collect_set("text")).alias("texts"))
    parted = F.transform("texts", lambda text, k: F.concat(
        text, F.lit(" \x00"), F.md5(F.concat_ws(":", F.lit("between"), F.col("doc_id").cast("string"), k.cast("string"))), F.lit("\x00 ")))
    held = stage(held.select("doc_id", "texts", parted.alias("parted")), "several-joined")
    joined = held.select("doc_id", F.array_join("parted", "").alias("text"))
    fronts = held.select("doc_id", F.posexplode("texts").alias("k", "text"), "parted").select(
        "doc_id", content_digest().alias("digest"), F.array_join(F.slice("parted", F.lit(1), F.col("k")), "").alias("before"))
    return texts.join(several, "doc_id", "left_anti").unionByName(joined), stage(fronts, "several-places")


def one_text_each(texts: DataFrame) -> DataFrame:
    """The rows (doc_id, text), with the first text in byte order, as one row, for each doc_id that has
    different ones."""
    own = texts.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("own"))
    ends = own.groupBy("doc_id").agg(F.min("own").alias("low"), F.max("own").alias("high"))
    several = stage(ends.filter("low <> high").select("doc_id"), "several-texts")
    if several.isEmpty():
        return texts
    chosen = texts.join(several, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    return stage(texts.join(several, "doc_id", "left_anti").unionByName(chosen), "one-text-each")


def with_place(rows: DataFrame, places: DataFrame | None, value: Column, name: str) -> DataFrame:
    """`rows` with `name`: `value` of what stands before the row's text in its document, else of an
    empty text."""
    if places is None:
        return rows.withColumn(name, F.lit(0).cast("long"))
    own = places.select("doc_id", "digest", value.cast("long").alias(name))
    found = rows.withColumn("digest", content_digest()) if "text" in rows.columns else rows
    return found.join(own, ["doc_id", "digest"], "left").drop("digest").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
