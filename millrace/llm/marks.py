"""Marking places of texts whose hash is met elsewhere, with packed shuffles.

A task hashes the places it is asked for, settles among its own batch what can be settled there,
and sends one row per batch and bucket with the rest, packed. So a hash that fills a third of all
places makes no more rows than there are batches (times one document's repeats). Buckets settle
the rest and send back, per batch, the marked places; a batch's marks become a row per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import encoded
from millrace.llm.frames import bucket_count, give_back

#: buckets a shuffle partition, or one for so many bytes of text; a batch sends a row to each
BUCKETS_PER_TASK = 2
BUCKET_BYTES = 64 << 20
#: texts of about so many bytes are one batch
BATCH_BYTES = 16 << 20
_ROW = "bucket int, batch long, sent boolean, hashes binary, docs binary, starts binary"
_MARKS = "batch long, docs binary, starts binary"
Places = tuple[np.ndarray, np.ndarray, np.ndarray]


def pack(values: np.ndarray, delta: bool = False) -> bytes:
    """Whole numbers by byte planes, compressed; `delta` for rising ones."""
    values = np.ascontiguousarray(values)
    if delta and len(values):
        values = np.diff(values, prepend=values[:1] * 0)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes, kind: str, delta: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    if not len(planes):
        return np.zeros(0, dtype=kind)
    values = np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()
    return np.cumsum(values).astype(kind) if delta else values


def plain(values: np.ndarray, kind: str) -> bytes:
    """Hashes, which don't compress."""
    return np.ascontiguousarray(values.astype(kind)).tobytes()


def _runs(hashes: np.ndarray, docs: np.ndarray, starts: np.ndarray):
    """Order by hash, document, start; per place in that order its run's first place, and the
    first and last document of its run."""
    order = np.lexsort((starts, docs, hashes))
    h, d = hashes[order], docs[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    heads = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    tails = np.append(heads[1:], len(h)) - 1 if len(h) else heads
    return order, heads[run], d[heads][run], d[tails][run], tails[run]


def settle(hashes: np.ndarray, docs: np.ndarray, starts: np.ndarray, later: bool, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """(marked, to be sent) for each place.

    later: a place is marked if its hash is met earlier; else if it is met anywhere else.
    across: only other documents count; else other places of the same document too.
    What is sent stands for the whole batch elsewhere, and asks for the places that others may mark.
    """
    order, head, low, high, tail = _runs(hashes, docs, starts)
    d, s, at = docs[order], starts[order], np.arange(len(order))
    first = (d == low) & (True if across else s == s[head])
    if later:
        marked = (d > low) if across else ~first
        sent = first
    else:
        marked = low != high if across else tail > head
        sent = np.where(marked, at == head, True)
    out = np.empty((2, len(order)), dtype=bool)
    out[0, order], out[1, order] = marked, sent
    return out[0], out[1]


def _batched(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in them:
        size = batch.column(1).nbytes
        rows = max(1, batch.num_rows * BATCH_BYTES // max(size, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
            give_back()


def mark(
    docs: DataFrame,
    places: Callable[[list[bytes], list], Iterator[Places]],
    later: bool,
    across: bool,
    wide: bool,
    size: int,
) -> DataFrame:
    """(doc_id, marks): for each document with marked places their starts, packed and rising.

    docs: doc_id, text and any further columns. places(texts, further values of each) yields
    (index of the text, start, hash); hashes have two lanes, shape (n, 2). With `wide`, all of the
    first lane is compared and the second lane chooses the bucket; else 32 bits of the first. `size`
    is that of all texts in bytes.
    Rows without a doc_id are left out. The rows must come in the same order if they are read
    again: from a table, not from a shuffle.
    """
    buckets = bucket_count(docs.sparkSession, BUCKETS_PER_TASK, size, BUCKET_BYTES)
    kind = "<u8" if wide else "<u4"

    def send(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(_batched(them)):
            ids = batch.column(0)
            batch = batch.filter(ids.is_valid())
            further = list(zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True)) or [()] * batch.num_rows
            parts = list(places(encoded(batch.column(1)), further))
            if not parts:
                continue
            at, starts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            lanes = np.concatenate([p[2] for p in parts])
            del parts
            if not len(at):
                continue
            own = batch.column(0).to_numpy()[at]
            marked, sent = settle(lanes[:, 0], own, starts, later, across)
            name = first + number
            rows = [(int(name % buckets), name, False, b"", *_places(own[marked], starts[marked]))] if marked.any() else []
            own, starts, lanes = own[sent], starts[sent], lanes[sent]
            bucket = (lanes[:, 1] % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((starts, own, bucket))
            own, starts, keys, bucket = own[order], starts[order], lanes[order, 0].astype(kind), bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
            rows += [
                (int(bucket[a]), name, True, plain(keys[a:b], kind), pack(own[a:b], True), pack(starts[a:b].astype("<u4")))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
            ]
            for k in range(0, len(rows), 256):
                yield _table(_SENT, rows[k : k + 256])

    def answer(table: pa.Table) -> pa.Table:
        rows = table.filter(table["sent"])
        out = [(x["batch"], x["docs"], x["starts"]) for x in table.filter(pa.compute.invert(table["sent"])).select(["batch", "docs", "starts"]).to_pylist()]
        if rows.num_rows:
            hashes = [np.frombuffer(x, dtype=kind) for x in rows["hashes"].to_pylist()]
            own = [unpack(x, "<i8", True) for x in rows["docs"].to_pylist()]
            starts = [unpack(x, "<u4") for x in rows["starts"].to_pylist()]
            ends = np.cumsum([len(x) for x in hashes])
            own, starts = np.concatenate(own), np.concatenate(starts).astype(np.int64)
            marked, _ = settle(np.concatenate(hashes), own, starts, later, across)
            for name, a, b in zip(rows["batch"].to_pylist(), (ends - [len(x) for x in hashes]).tolist(), ends.tolist(), strict=True):
                hit = marked[a:b]
                if hit.any():
                    out.append((name, *_places(own[a:b][hit], starts[a:b][hit])))
        return pa.Table.from_batches([_table(_ANSWER, out)])

    def gather(table: pa.Table) -> pa.Table:
        own = np.concatenate([unpack(x, "<i8", True) for x in table["docs"].to_pylist()])
        starts = np.concatenate([unpack(x, "<u4") for x in table["starts"].to_pylist()])
        order = np.lexsort((starts, own))
        own, starts = own[order], starts[order]
        keep = np.ones(len(own), dtype=bool)
        keep[1:] = (own[1:] != own[:-1]) | (starts[1:] != starts[:-1])
        own, starts = own[keep], starts[keep]
        edges = np.append(np.flatnonzero(np.diff(own, prepend=own[0] - 1)), len(own))
        marks = [pack(starts[a:b], True) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return pa.table({"doc_id": pa.array(own[edges[:-1]]), "marks": pa.array(marks, pa.binary())})

    sent = docs.mapInArrow(send, _ROW)
    answered = sent.groupBy("bucket").applyInArrow(answer, _MARKS)
    gathered = answered.groupBy("batch").applyInArrow(gather, "doc_id long, marks binary")
    return gathered.groupBy("doc_id").agg(F.collect_list("marks").alias("marks"))


def starts_of(marks: list[bytes] | None) -> np.ndarray:
    """The rising starts of one document's marks."""
    return np.unique(np.concatenate([unpack(x, "<u4", True) for x in marks])).astype(np.int64) if marks else np.zeros(0, np.int64)


_SENT = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("sent", pa.bool_()), ("hashes", pa.binary()), ("docs", pa.binary()), ("starts", pa.binary())])
_ANSWER = pa.schema([("batch", pa.int64()), ("docs", pa.binary()), ("starts", pa.binary())])


def _places(docs: np.ndarray, starts: np.ndarray) -> tuple[bytes, bytes]:
    order = np.lexsort((starts, docs))
    return pack(docs[order].astype("<i8"), True), pack(starts[order].astype("<u4"))


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
