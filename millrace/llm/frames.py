"""Shared rules for the frames that operators take and give."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns whose names an operator gives to its own results."""
    lowered = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in lowered])


def widened(schema: StructType, ddl: str) -> StructType:
    """A frame's schema with more fields at its end."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def give_back() -> None:
    """Hand freed memory back to the system. Workers live on between tasks, and what the allocators
    keep of one task's arrays counts against the executor while others run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same work on a task's batches, giving freed memory back at the end."""

    @wraps(work)
    def run(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(them)
        finally:
            give_back()

    return run


def text_bytes(texts: DataFrame) -> int:
    """Bytes of all texts."""
    return texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def bucket_count(spark: SparkSession, per_task: int, size: int, each: int) -> int:
    """How many buckets `size` bytes of text go to: `per_task` a shuffle partition, or more, so that
    one holds what `each` bytes of text send at most."""
    return max(per_task * task_count(spark), -(-size // each))


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
