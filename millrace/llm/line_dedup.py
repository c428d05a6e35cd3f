"""Line deduplication by sharded minimal perfect hashes.

Every distinct line hash gets a slot of a minimal perfect hash in its shard; the slots
index compact arrays: fingerprint, first and last document, number of documents. Documents
send the hashes of their lines to the shards and probe the arrays there.

A line's key is the line with white space (blank, 0x09 to 0x0D) stripped at both ends and
A-Z lower-cased. A key of at least `min_chars` code points that two or more documents hold
stays only in the smallest doc_id that holds it, there with all its repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import mix
from millrace.llm.frames import task_count, tidy, widened, without
from millrace.session import stage

MIN_CHARS = 10
SHARD_LINES = 500_000
_ENTRY = "key_hi long, key_lo long, first_doc long, last_doc long, docs long, sure boolean"
_INDEX = "shard int, levels binary, sizes binary, prints binary, first_docs binary, last_docs binary, docs binary"


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def code_points(raw: bytes) -> int:
    return len(raw.decode("utf-8", "replace"))


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


class PerfectHash:
    """Maps n distinct 64-bit keys to 0..n-1. Each level holds a bit array; a key takes the
    first level at which no other remaining key meets its bit, and its slot is the bit's rank."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.ranks = np.cumsum(bits) - bits

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 1.5) -> PerfectHash:
        levels, sizes, left = [], [], keys
        while len(left):
            size = max(int(gamma * len(left)), 8)
            place = cls._place(left, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            left = left[~alone[place]]
        bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
        return cls(bits.astype(np.int64), np.array(sizes, dtype=np.int64))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salted = mix(keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1)))
        return (salted % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; a key that isn't among the built ones gets any slot, or -1."""
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (offset, size) in enumerate(zip(self.offsets, self.sizes, strict=True)):
            if not len(left):
                break
            at = offset + self._place(keys[left], level, int(size))
            hit = self.bits[at] == 1
            found[left[hit]] = self.ranks[at[hit]]
            left = left[~hit]
        return found


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def line_entries(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per batch of documents and line key one row: the batch's first and last holder and the
    number of holders. So a line that a third of all documents hold makes a row a batch. Holders
    after the batch's first lose the line in any case; they get a row each with `sure`."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key_hi", pa.int64()), ("key_lo", pa.int64()), ("first_doc", pa.int64()),
                            ("last_doc", pa.int64()), ("docs", pa.int64()), ("sure", pa.bool_())])
        for batch in them:
            holders: dict[bytes, set[int]] = {}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if doc is None or not text:
                    continue
                for line in text.encode().split(b"\n"):
                    key = line_key(line)
                    if len(key) >= min_chars and code_points(key) >= min_chars:
                        holders.setdefault(_digest(key), set()).add(doc)
            rows = []
            for key, its in holders.items():
                first = min(its)
                rows.append((key, first, max(its), len(its), False))
                if len(its) > 1:
                    rows.extend((key, doc, doc, 1, True) for doc in its if doc != first)
            if not rows:
                continue
            keys = np.frombuffer(b"".join(r[0] for r in rows), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), *[pa.array([r[i] for r in rows]) for i in (1, 2, 3, 4)]],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(batches), _ENTRY)


def build_index(entries: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash over the shard's distinct line hashes and the arrays
    in slot order. Lines are summed up before they meet in a shard."""
    lines = (
        entries.filter(~F.col("sure"))
        .groupBy("key_hi", "key_lo")
        .agg(F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc"), F.sum("docs").alias("docs"))
        .withColumn("shard", F.pmod("key_hi", F.lit(shards)).cast("int"))
    )

    def shard(table: pa.Table) -> pa.Table:
        keys = _unsigned(table["key_lo"])
        own, at = np.unique(keys, return_index=True)  # equal lower halves share a slot's print check
        function = PerfectHash.build(own)
        slots = function.slots(own)
        order = np.empty(len(own), dtype=np.int64)
        order[slots] = at
        column = lambda name, kind: table[name].to_numpy()[order].astype(kind).tobytes()
        return pa.table({
            "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
            "levels": pa.array([np.packbits(function.bits.astype(np.uint8)).tobytes()], pa.binary()),
            "sizes": pa.array([function.sizes.astype("<i8").tobytes()], pa.binary()),
            "prints": pa.array([column("key_hi", "<i8")], pa.binary()),
            "first_docs": pa.array([column("first_doc", "<i8")], pa.binary()),
            "last_docs": pa.array([column("last_doc", "<i8")], pa.binary()),
            "docs": pa.array([column("docs", "<i8")], pa.binary()),
        })

    return lines.groupBy("shard").applyInArrow(shard, _INDEX)


def probe(entries: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(doc_id, key) of each line that a document must lose: the arrays say that others hold the
    line too, and the first of them is another document."""
    asked = entries.filter(~F.col("sure")).withColumn("shard", F.pmod("key_hi", F.lit(shards)).cast("int"))

    def answer(rows: pa.Table, arrays: pa.Table) -> pa.Table:
        keys = _unsigned(rows["key_lo"])
        docs = rows["first_doc"].to_numpy()
        lost = np.zeros(len(keys), dtype=bool)
        if arrays.num_rows and len(keys):
            read = lambda name: np.frombuffer(arrays[name][0].as_py(), dtype="<i8")
            sizes = read("sizes")
            bits = np.unpackbits(np.frombuffer(arrays["levels"][0].as_py(), dtype=np.uint8))[: int(sizes.sum())]
            slots = PerfectHash(bits.astype(np.int64), sizes).slots(keys)
            known = slots >= 0
            known[known] = read("prints")[slots[known]] == rows["key_hi"].to_numpy()[known]
            at = slots[known]
            shared = read("first_docs")[at] != read("last_docs")[at]
            lost[known] = shared & (read("first_docs")[at] != docs[known])
        return pa.table({
            "doc_id": pa.array(docs[lost]),
            "key_hi": pa.array(rows["key_hi"].to_numpy()[lost]),
            "key_lo": pa.array(rows["key_lo"].to_numpy()[lost]),
        })

    found = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(
        answer, "doc_id long, key_hi long, key_lo long"
    )
    sure = entries.filter("sure").select(F.col("first_doc").alias("doc_id"), "key_hi", "key_lo")
    return found.unionByName(sure)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` (doc_id, text, any others) with `text` less its repeated lines, and n_lines and
    n_dropped (long). Columns that already have these names are replaced.

    A null text is one empty line, and its new text is empty. Rows without a doc_id take no part:
    they keep their lines. Rows that share a doc_id count as one document. An empty table gives
    an empty table.
    """
    spark = docs.sparkSession
    docs = without(docs, "n_lines", "n_dropped", "_lost")
    entries = stage(line_entries(docs, min_chars), "line-entries")
    shards = max(task_count(spark), -(-entries.count() // SHARD_LINES))
    index = stage(build_index(entries, shards), "line-index")
    lost = (
        probe(entries, index, shards)
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("key_hi", "key_lo")).alias("_lost"))
    )
    joined = docs.join(lost, "doc_id", "left").select(*[f"`{c}`" for c in docs.columns], "_lost")
    names = [*docs.columns, "n_lines", "n_dropped"]
    place = names.index("text")

    def rewrite(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            texts, total, dropped = [], [], []
            for text, lose in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                kept = lines
                if lose:
                    keys = {np.array([x["key_hi"], x["key_lo"]], dtype="<i8").tobytes() for x in lose}
                    kept = [x for x in lines if _digest(line_key(x.encode())) not in keys]
                texts.append("\n".join(kept))
                total.append(len(lines))
                dropped.append(len(lines) - len(kept))
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
                names=names,
            )

    return joined.mapInArrow(tidy(rewrite), widened(docs.schema, "n_lines long, n_dropped long"))
