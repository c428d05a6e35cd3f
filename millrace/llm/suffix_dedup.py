"""Byte substring deduplication by suffix arrays.

Every window of `width` bytes has a minimizer, the least hash among the runs of KMER bytes in it;
equal windows have equal minimizers. Only stretches whose minimizer other documents have too go to a
shard, the one that the minimizer names, so equal windows meet in one shard. There a suffix array,
made by external induced sorting, brings equal windows together: neighbours whose common prefix
reaches `width` are equal, and those that don't lie in the smallest document are removed.

What needs no sorting is settled by hashes first. Documents whose whole text an earlier document has
go whole; equal stretches are sorted once. And a window reaches far enough on one side of its
minimizer, by half of what it has besides, that two different stretches share a window only if
they share such a side. A stretch is sorted as far as its sides are shared with different stretches
of other documents.

A minimizer under which very many different stretches lie would make one large shard. Such
minimizers are found on a share of the documents; their stretches are cut into single windows,
each going to the shard that its own hash names. Equal windows have equal minimizers and hashes,
so they meet whichever minimizers are taken for hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import CHUNK_BYTES, byte_values, chunked, encoded, span_hashes, spanned
from millrace.llm.frames import bucket_count, text_bytes, widened, without
from millrace.llm.induced import MEMORY, Scratch, suffix_array
from millrace.llm.marks import Places, _batched, mark, pack, plain, settle, starts_of, unpack
from millrace.llm.repeats import content_digest, one_document_each, with_place
from millrace.operators.joins import spread_join
from millrace.session import stage

WIDTH = 50
KMER = 16
#: shards a shuffle partition, or one for so many bytes of text
SHARDS_PER_TASK = 4
SHARD_BYTES = 32 << 20
#: different stretches of about so many bytes under one minimizer are cut into windows
HOT_BYTES = 8 << 20
#: one document in so many is looked at for hot minimizers
HOT_SAMPLE = 16
#: more hot minimizers than this are not dealt apart; they are broadcast
HOT_MINIMIZERS = 1 << 20
#: texts of so many bytes are hashed together, so that the work arrays stay in a core's cache
HASHED_BYTES = 1 << 17
_PIECES = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("sent", pa.bool_()), ("docs", pa.binary()),
                     ("starts", pa.binary()), ("sizes", pa.binary()), ("keys", pa.binary()), ("at", pa.binary()), ("bytes", pa.binary())])
_SPANS = pa.schema([("batch", pa.int64()), ("docs", pa.binary()), ("starts", pa.binary()), ("sizes", pa.binary())])


class Minimizers:
    """The windows of one chunk of texts: their places, and the place of each one's minimizer."""

    def __init__(self, texts: list[bytes], width: int):
        joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.joined = joined
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.first = np.cumsum(lengths) - lengths
        counts = np.maximum(lengths - width + 1, 0)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.windows = np.arange(len(self.text)) + np.repeat(self.first - (np.cumsum(counts) - counts), counts)
        places = np.arange(max(len(joined) - KMER + 1, 0))
        self.hashes = span_hashes(byte_values(joined), places, places + KMER)
        bits = np.uint64(max(len(places), 1).bit_length())
        # the place in the low bits: of equal hashes the first is the least
        least = ((self.hashes >> bits) << bits) | places.astype(np.uint64)
        span, done = width - KMER + 1, 1
        while 2 * done <= span:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < span:
            least = np.minimum(least[: len(least) - (span - done)], least[span - done :])
        self.place = (least[self.windows] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.ones(len(self.place), dtype=bool)
        new[1:] = (self.place[1:] != self.place[:-1]) | (self.text[1:] != self.text[:-1])
        self.heads = np.flatnonzero(new)  # windows at which another minimizer begins
        self.tails = np.append(self.heads[1:], len(self.place)) - 1 if len(self.heads) else self.heads


def minimizer_places(width: int):
    def places(texts: list[bytes], _: list) -> Iterator[Places]:
        for first, last in chunked(texts, HASHED_BYTES):
            found = Minimizers(texts[first:last], width)
            place, text = found.place[found.heads], found.text[found.heads]
            if len(place):
                own = found.hashes[place]
                lanes = np.stack([own, own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)], axis=1)
                yield first + text, place - found.first[text], lanes

    return places


def _packed(docs: np.ndarray, *more: np.ndarray) -> list[bytes]:
    return [pack(docs.astype("<i8"), True), *[pack(x.astype("<u4")) for x in more]]


def _batch_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def hot_minimizers(texts: DataFrame, width: int) -> np.ndarray:
    """The hashes, rising, of minimizers with about HOT_BYTES of different stretches, the heaviest
    HOT_MINIMIZERS of them. They only say how stretches are dealt."""

    def weigh(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(them):
            raw = encoded(batch.column(1))
            parts = []
            for first, last in chunked(raw, HASHED_BYTES):
                found = Minimizers(raw[first:last], width)
                begin, end = found.windows[found.heads], found.windows[found.tails] + width
                key = span_hashes(byte_values(found.joined), begin, end)
                parts.append(np.stack([found.hashes[found.place[found.heads]], key, (end - begin).astype(np.uint64)]))
            if not parts:
                continue
            lane, key, size = np.concatenate(parts, axis=1)
            order = np.lexsort((key, lane))
            lane, key, size = lane[order], key[order], size[order]
            new = np.ones(len(lane), dtype=bool)
            new[1:] = (lane[1:] != lane[:-1]) | (key[1:] != key[:-1])
            lane, size = lane[new], size[new]
            heads = np.flatnonzero(np.append(True, lane[1:] != lane[:-1])) if len(lane) else np.zeros(0, np.int64)
            several = np.diff(np.append(heads, len(lane))) > 1
            if several.any():
                total = np.add.reduceat(size, heads)[several]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lane[heads][several].view(np.int64)), pa.array(total.astype(np.int64))], names=["lane", "size"])

    sample = texts.filter("doc_id is not null").filter(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SAMPLE)) == 0)
    weights = sample.mapInArrow(weigh, "lane long, size long").groupBy("lane").agg(F.sum("size").alias("size"))
    heavy = weights.filter(F.col("size") * HOT_SAMPLE > HOT_BYTES)
    rows = heavy.orderBy(F.desc("size"), "lane").limit(HOT_MINIMIZERS).select("lane").collect()
    return np.sort(np.array([r["lane"] for r in rows], dtype=np.int64).view(np.uint64))


def _pieces(near: DataFrame, width: int, shards: int, hot: np.ndarray) -> DataFrame:
    """Stretches under one shared minimizer, packed by batch and shard. Of equal stretches in a
    batch only the first document's are sent; the others' are removed in any case. Under hot
    minimizers each window is a stretch of its own, dealt by its hash."""
    shared_hot = near.sparkSession.sparkContext.broadcast(hot)

    def send(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, hot = TaskContext.get().partitionId() << 32, shared_hot.value
        for number, batch in enumerate(_batched(them)):
            name = base + number
            ids, texts = batch.column(0).to_numpy(), encoded(batch.column(1))
            marks = batch.column(2).to_pylist()
            owner, starts, sizes, lane, key, at_, raw = [], [], [], [], [], [], []
            for first, last in chunked(texts, HASHED_BYTES):
                found = Minimizers(texts[first:last], width)
                shared = np.zeros(len(found.joined) + 1, dtype=bool)
                for i in range(first, last):
                    shared[found.first[i - first] + starts_of(marks[i])] = True
                chosen = np.flatnonzero(shared[found.place[found.heads]])
                heads, tails = found.heads[chosen], found.tails[chosen]
                begin, end = found.windows[heads], found.windows[tails] + width
                place = found.place[heads]
                text, name_of = found.text[heads], found.hashes[place]
                cut = np.isin(name_of, hot)
                if cut.any():
                    counts = np.where(cut, end - begin - width + 1, 1)
                    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    begin, end, text, name_of, cut, place = (np.repeat(x, counts) for x in (begin, end, text, name_of, cut, place))
                    begin = begin + step
                    end = np.where(cut, begin + width, end)
                own = span_hashes(byte_values(found.joined), begin, end)
                owner.append(ids[first + text])
                starts.append(begin - found.first[text])
                sizes.append(end - begin)
                lane.append(np.where(cut, own, name_of))
                key.append(own)
                at_.append(place - begin)
                whole = found.joined.tobytes()
                raw += [whole[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            if not raw:
                continue
            owner, starts, sizes, lane, key, at_ = (np.concatenate(x) for x in (owner, starts, sizes, lane, key, at_))
            marked, sent = settle(key, owner, starts, later=True, across=True)
            rows = []
            if marked.any():
                at = np.flatnonzero(marked)
                at = at[np.lexsort((starts[at], owner[at]))]
                rows.append((int(name % shards), name, False, *_packed(owner[at], starts[at], sizes[at]), b"", b"", b""))
            shard = (lane % np.uint64(shards)).astype(np.int64)
            at = np.flatnonzero(sent)
            at = at[np.lexsort((starts[at], owner[at], shard[at]))]
            edges = np.flatnonzero(np.diff(shard[at], prepend=-1, append=shards)).tolist()
            squeeze = zstandard.ZstdCompressor(level=3)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                take = at[a:b]
                rows.append((int(shard[take[0]]), name, True, *_packed(owner[take], starts[take], sizes[take]),
                             plain(lane[take] >> np.uint64(32), "<u4"), pack(at_[take].astype("<u4")), squeeze.compress(b"".join([raw[i] for i in take.tolist()]))))
            for k in range(0, len(rows), 256):
                yield _batch_of(_PIECES, rows[k : k + 256])

    return near.mapInArrow(send, "shard int, batch long, sent boolean, docs binary, starts binary, sizes binary, keys binary, at binary, bytes binary")


def repeated_windows(pieces: bytes, sizes: np.ndarray, docs: np.ndarray, width: int, memory: int = MEMORY):
    """(piece, offset, size) of the stretches whose windows also start in a smaller document.
    pieces: the bytes of all pieces in turn."""
    scratch = Scratch(memory)
    firsts = np.cumsum(sizes + 1) - (sizes + 1)
    n = int(firsts[-1] + sizes[-1] + 2)
    text = scratch.array(n, np.uint8)
    raw = np.frombuffer(pieces, dtype=np.uint8)
    for a, b in scratch.blocks(len(sizes)):  # 1 ends a piece; no byte of UTF-8 exceeds 0xF4
        low, high = int(firsts[a]), int(firsts[b - 1] + sizes[b - 1] + 1)
        inside = np.ones(high - low, dtype=bool)
        inside[firsts[a:b] + sizes[a:b] - low] = False
        part = np.ones(high - low, dtype=np.uint8)
        part[inside] = raw[low - a : high - b] + np.uint8(2)
        text[low:high] = part
    text[-1:] = 0
    edge = scratch.array(n, np.int8)
    edge[:] = 0
    wide = sizes >= width
    edge[firsts[wide]] = 1
    edge[(firsts + sizes - width + 1)[wide]] = -1
    begins, open_ = scratch.array(n, bool), 0  # whether a window begins here
    for a, b in scratch.blocks(n):
        now = np.cumsum(edge[a:b], dtype=np.int8) + np.int8(open_)
        begins[a:b], open_ = now > 0, int(now[-1])
    places, prefixes = suffix_array(text, width, memory)
    hit = edge
    hit[:] = 0
    a = 0
    while a < n:
        b = min(a + scratch.memory, n)
        while b < n and prefixes[b] >= width:  # to the end of a run of equal windows
            more = np.flatnonzero(prefixes[b : b + scratch.memory] < width)
            b = b + int(more[0]) if len(more) else min(b + scratch.memory, n)
        own_places = np.asarray(places[a:b])
        at = np.flatnonzero(begins[own_places])
        run = np.cumsum(prefixes[a:b] < width)[at]
        own_places = own_places[at]
        own = docs[np.searchsorted(firsts, own_places, side="right") - 1]
        if len(own):
            heads = np.flatnonzero(np.diff(run, prepend=-1))
            low = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.append(heads, len(run))))
            hit[own_places[own > low]] = 1
        a = b
    begin, end, before = [], [], 0
    for a, b in scratch.blocks(n):
        edges = np.diff(hit[a:b], prepend=np.int8(before))
        begin.append(a + np.flatnonzero(edges == 1))
        end.append(a + np.flatnonzero(edges == -1))
        before = int(hit[b - 1])
    begin, end = np.concatenate(begin), np.concatenate(end)  # the last place, the text's end, begins no window
    piece = np.searchsorted(firsts, begin, side="right") - 1
    return piece, begin - firsts[piece], end - begin + width - 1


def _span_hashes(raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each run raw[begin:end], some runs at a time; `begin` rises."""
    out, at = np.empty((len(begin), 2), dtype=np.uint64), 0
    joined = np.frombuffer(raw, dtype=np.uint8)
    while at < len(begin):
        low = int(begin[at])
        stop = max(at + 1, int(np.searchsorted(begin, low + CHUNK_BYTES, side="right")))
        part = joined[low : int(end[at:stop].max())]
        for lane in (0, 1):
            out[at:stop, lane] = span_hashes(byte_values(part, lane), begin[at:stop] - low, end[at:stop] - low)
        at = stop
    return out


def shared_reaches(raw: bytes, begin: np.ndarray, sizes: np.ndarray, at: np.ndarray, docs: np.ndarray, width: int):
    """(start, end) within each of these different pieces of what may hold a window that another of them
    has too, in another document; empty where nothing can.

    A window has `width - KMER` bytes besides its minimizer, so half of these lie before or half
    behind it. With as many bytes as that, the run that ends, or begins, with the minimizer is
    the same wherever the window is.
    """
    half = -(-(width - KMER) // 2)
    side = KMER + half
    start, end = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    front = np.flatnonzero(at >= half)
    back = np.flatnonzero(sizes - at >= side)
    place = begin + at
    # the run before ends with the minimizer, the run behind begins with it
    for own, low, reach in ((front, place[front] - half, (np.zeros(len(front), np.int64), np.minimum(at[front] + side, sizes[front]))),
                            (back, place[back], (np.maximum(at[back] - half, 0), sizes[back]))):
        if not len(own):
            continue
        hashes = _span_hashes(raw, low, low + side)
        order = np.lexsort((docs[own], hashes[:, 1], hashes[:, 0]))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[order[1:]] != hashes[order[:-1]]).any(axis=1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(order)) - 1
        run = np.cumsum(new) - 1
        met = np.empty(len(order), dtype=bool)
        met[order] = (docs[own][order[heads]] < docs[own][order[tails]])[run]
        hit = own[met]
        empty = end[hit] == 0
        start[hit] = np.where(empty, reach[0][met], np.minimum(start[hit], reach[0][met]))
        end[hit] = np.maximum(end[hit], reach[1][met])
    short = end - start < width
    start[short] = end[short] = 0
    return start, end


def distinct_windows(raw: bytes, sizes: np.ndarray, at: np.ndarray, docs: np.ndarray, width: int, memory: int = MEMORY):
    """As repeated_windows, with equal pieces taken once, in the name of the smallest document: the
    pieces of other documents go whole, those of the same one lose what it loses. Of the rest only
    what may hold a window of another piece is sorted. at: where each piece's minimizer begins."""
    begin = np.cumsum(sizes) - sizes
    hashes = _span_hashes(raw, begin, begin + sizes)
    order = np.lexsort((docs, hashes[:, 1], hashes[:, 0]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]).any(axis=1)
    chief = np.empty(len(order), dtype=np.int64)
    chief[order] = order[new][np.cumsum(new) - 1]
    chiefs = np.sort(order[new])
    start, end = shared_reaches(raw, begin[chiefs], sizes[chiefs], at[chiefs], docs[chiefs], width)
    reached = np.flatnonzero(end)
    near, start, end = chiefs[reached], start[reached], end[reached]
    piece = offset = size = np.zeros(0, np.int64)
    if len(near):
        low = begin[near]
        kept = b"".join([raw[x:y] for x, y in zip((low + start).tolist(), (low + end).tolist(), strict=True)])
        piece, offset, size = repeated_windows(kept, end - start, docs[near], width, memory)
        offset = offset + start[piece]
        piece = near[piece]
    whole = np.flatnonzero(docs > docs[chief])
    same = np.flatnonzero((docs == docs[chief]) & (chief != np.arange(len(docs))))
    low, high = (np.searchsorted(piece, chief[same], side=x) for x in ("left", "right"))
    counts = high - low
    take = np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)
    pieces = np.concatenate((piece, whole, np.repeat(same, counts)))
    offsets = np.concatenate((offset, np.zeros(len(whole), np.int64), offset[take]))
    lengths = np.concatenate((size, sizes[whole], size[take]))
    order = np.argsort(pieces, kind="stable")
    return pieces[order], offsets[order], lengths[order]


def _sorted_shards(pieces: DataFrame, width: int, memory: int) -> DataFrame:
    """Per batch the spans that go."""

    def sort(table: pa.Table) -> pa.Table:
        out = [tuple(x.values()) for x in table.filter(pa.compute.invert(table["sent"])).select(_SPANS.names).to_pylist()]
        rows = table.filter(table["sent"])
        if rows.num_rows:
            docs = [unpack(x, "<i8", True) for x in rows["docs"].to_pylist()]
            starts, sizes, at = (np.concatenate([unpack(x, "<u4") for x in rows[c].to_pylist()]).astype(np.int64) for c in ("starts", "sizes", "at"))
            source = np.repeat(np.arange(rows.num_rows), [len(x) for x in docs])
            docs = np.concatenate(docs)
            expand = zstandard.ZstdDecompressor()
            raw = b"".join(expand.decompress(x) for x in rows["bytes"].to_pylist())
            # a minimizer that one document has left, its copies being settled, needs no sorting
            keys = np.concatenate([np.frombuffer(x, dtype="<u4") for x in rows["keys"].to_pylist()])
            several = np.flatnonzero(settle(keys, docs, starts, later=False, across=True)[0])
            if not len(several):
                return pa.Table.from_batches([_batch_of(_SPANS, out)])
            ends = np.cumsum(sizes)
            raw = b"".join([raw[x:y] for x, y in zip((ends - sizes)[several].tolist(), ends[several].tolist(), strict=True)])
            piece, offset, size = distinct_windows(raw, sizes[several], at[several], docs[several], width, memory)
            piece = several[piece]
            names = rows["batch"].to_pylist()
            edges = np.searchsorted(source[piece], np.arange(rows.num_rows + 1)).tolist()
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if a < b:
                    p = piece[a:b]
                    order = np.lexsort((offset[a:b], starts[p], docs[p]))
                    out.append((names[k], *_packed(docs[p][order], (starts[p] + offset[a:b])[order], size[a:b][order])))
        return pa.Table.from_batches([_batch_of(_SPANS, out)])

    def gather(table: pa.Table) -> pa.Table:
        docs = np.concatenate([unpack(x, "<i8", True) for x in table["docs"].to_pylist()])
        starts, sizes = (np.concatenate([unpack(x, "<u4") for x in table[c].to_pylist()]) for c in ("starts", "sizes"))
        order = np.lexsort((starts, docs))
        docs, starts, sizes = docs[order], starts[order], sizes[order]
        edges = np.append(np.flatnonzero(np.diff(docs, prepend=docs[0] - 1)), len(docs)).tolist()
        spans = [(pack(starts[a:b]), pack(sizes[a:b])) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.table({"doc_id": pa.array(docs[edges[:-1]]), "starts": pa.array([s[0] for s in spans], pa.binary()),
                         "sizes": pa.array([s[1] for s in spans], pa.binary())})

    sorted_ = pieces.groupBy("shard").applyInArrow(sort, "batch long, docs binary, starts binary, sizes binary")
    gathered = sorted_.groupBy("batch").applyInArrow(gather, "doc_id long, starts binary, sizes binary")
    return gathered.groupBy("doc_id").agg(F.collect_list(F.struct("starts", "sizes")).alias("_spans"))


def _copies(texts: DataFrame) -> DataFrame:
    """doc_id of the documents whose whole text a smaller doc_id has. A very common text is dealt."""
    rows = texts.filter("doc_id is not null").select("doc_id", content_digest().alias("digest"), F.octet_length("text").alias("size"))
    held = stage(rows, "suffix-digests")
    sizes = stage(held.groupBy("digest", "size").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("first <> last"), "suffix-copied")
    met = spread_join(held, sizes.select("digest", "size", "first"), ["digest", "size"], ["doc_id"], sizes.select("digest", "size", "n"))
    return met.filter("doc_id <> first").select("doc_id").distinct()


def dedup_bytes(docs: DataFrame, width: int = WIDTH, memory: int = MEMORY) -> DataFrame:
    """`docs` (doc_id, text, any others) with n_bytes, n_removed, n_spans (long) and kept (binary).
    Columns that already have these names are replaced.

    A byte goes if a string of `width` bytes that covers it also starts in a document with a
    smaller doc_id. Strings are judged on the whole input; n_spans counts the runs that go. What is
    kept may cut a character. A null text is empty. Rows without a doc_id take no part. Rows that
    share a doc_id are one document: they don't make each other lose anything, and each loses what
    smaller documents have of its own text. Texts have any length; one is held whole by a task. An
    empty table gives an empty table. The rows must come in the same order if they are read again:
    from a table.
    """
    docs = without(docs, "n_bytes", "n_removed", "n_spans", "kept", "_spans", "_whole", "_before", "digest")
    texts, places = one_document_each(docs.select("doc_id", "text"))
    if places is not None:
        texts = stage(texts, "suffix-texts")
    copies = stage(_copies(texts), "suffix-copies")
    size = text_bytes(texts)
    marks = mark(texts, minimizer_places(width), later=False, across=True, wide=False, size=size)
    near = texts.join(marks.join(copies, "doc_id", "left_anti"), "doc_id").select("doc_id", "text", "marks")
    pieces = _pieces(near, width, bucket_count(docs.sparkSession, SHARDS_PER_TASK, size, SHARD_BYTES), hot_minimizers(texts, width))
    spans = _sorted_shards(pieces, width, memory)
    gone = spans.join(copies.withColumn("_whole", F.lit(True)), "doc_id", "full")
    placed = with_place(docs, places, F.octet_length("before"), "_before")
    joined = placed.join(gone, "doc_id", "left").select(*[f"`{c}`" for c in docs.columns], "_before", "_spans", "_whole")
    names = [*docs.columns, "n_bytes", "n_removed", "n_spans", "kept"]
    place = names.index("text")

    def rewrite(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            own = []
            before, spans, wholes = (batch.column(batch.num_columns - k).to_pylist() for k in (3, 2, 1))
            for raw, front, found, whole in zip(encoded(batch.column(place)), before, spans, wholes, strict=True):
                runs, kept = 0, raw
                if whole and len(raw) >= width:
                    runs, kept = 1, b""
                elif found and raw:
                    starts, sizes = (np.concatenate([unpack(x[c], "<u4") for x in found]).astype(np.int64) for c in ("starts", "sizes"))
                    goes = spanned(*(np.clip(x - front, 0, len(raw)) for x in (starts, starts + sizes)), len(raw))
                    runs = int((goes[1:] & ~goes[:-1]).sum() + goes[0])
                    kept = np.frombuffer(raw, dtype=np.uint8)[~goes].tobytes()
                own.append((len(raw), len(raw) - len(kept), runs, kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *[pa.array([r[i] for r in own], k) for i, k in enumerate(kinds)]], names=names)

    return joined.mapInArrow(rewrite, widened(docs.schema, "n_bytes long, n_removed long, n_spans long, kept binary"))
