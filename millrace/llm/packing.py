"""Packing by concatenating and cutting.

All documents form one stream of ids. The first pass encodes the texts and stores each
document's ids with its place in its block (a task's documents); block totals give global
offsets. The second pass cuts the stream into windows of `width` ids: a document is one piece
per window that it reaches, the pieces at a window's edges being the boundary records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.chunks import encoded
from millrace.llm.frames import tidy
from millrace.llm.tokenizing import word_encoder
from millrace.session import stage

WIDTH = 4096
END_ID = 2
_TOKENS = "doc_id long, block int, block_start long, doc_tokens long, ids binary"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Each document's ids (little-endian, 32 bits) with `end_id` at their end, its block, and the
    number of ids before it in the block."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, before = word_encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4")
        for batch in them:
            ids_of = encoder.encode(encoded(batch.column(1)))
            for at in range(0, batch.num_rows, 512):
                docs = batch.column(0).slice(at, 512)
                ids = [np.concatenate((next(ids_of), end)).astype("<u4") for _ in range(len(docs))]
                sizes = np.array([len(x) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(np.full(len(docs), block, dtype=np.int32)),
                     pa.array(before + np.cumsum(sizes) - sizes), pa.array(sizes),
                     pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "block", "block_start", "doc_tokens", "ids"],
                )
                before += int(sizes.sum())

    return docs.select("doc_id", "text").mapInArrow(tidy(batches), _TOKENS)


def pack(docs: DataFrame, tokenizer: str, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of `width` ids: doc_id, start (the document's ids before
    the piece), length, doc_tokens, sequence_id, offset (in the sequence) and ids (binary).

    A null or empty text has the end id alone. Every row makes its own pieces, also where rows
    repeat or have no doc_id; other columns take no part. Rows stand as the table gives them, so none
    ties with another. Texts have any length; one's ids are held whole by a task. Only the last
    sequence may be short; an empty table gives no pieces. A tokenizer file of a kind that words can't
    be encoded apart for is refused with a ValueError.
    """
    tokens = stage(encode_documents(docs, tokenizer, end_id), "packing-tokens")
    totals = tokens.groupBy("block").agg(F.sum("doc_tokens").alias("total"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    blocks = totals.select("block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("block_offset"))
    first = F.col("block_offset") + F.col("block_start")
    laid = tokens.join(F.broadcast(blocks), "block").select(
        "doc_id", "doc_tokens", "ids", first.alias("first"), (first + F.col("doc_tokens")).alias("end")
    )
    window = F.explode(F.expr(f"sequence(first div {width}, (end - 1) div {width})"))
    return (
        laid.select("*", window.alias("sequence_id"))
        .withColumn("_from", F.greatest("first", F.col("sequence_id") * width))
        .withColumn("_to", F.least("end", (F.col("sequence_id") + 1) * width))
        .select(
            "doc_id",
            (F.col("_from") - F.col("first")).alias("start"),
            (F.col("_to") - F.col("_from")).alias("length"),
            "doc_tokens",
            "sequence_id",
            (F.col("_from") - F.col("sequence_id") * width).alias("offset"),
            F.expr("substring(ids, cast(4 * (_from - first) + 1 as int), cast(4 * (_to - _from) as int))").alias("ids"),
        )
    )


def assemble(pieces: DataFrame) -> DataFrame:
    """One row a sequence: sequence_id, length, ids (binary). A sequence holds at most `width` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.lit(b""), lambda held, part: F.concat(held, part["ids"])).alias("ids"),
    )
