"""Jaccard join of word shingle sets by parity sketches.

A set's shingles fall into the parts of a sketch, as many as the power of two of its size band;
a part holds the XOR of random numbers of its shingles. A shingle that only one of two sets has
changes one part, so the number of differing parts is at most the symmetric difference, which is
at most a quarter of the smaller set where two sets are similar enough. By the pigeonhole
principle similar sets then agree on one of the first quarter + 1 of their filled parts, in an
order that all sets share: parts of many shingles first. Sets that meet in a part are candidates;
the Hamming distance of finer bit sketches, a lower bound of the difference too, drops most of
them, and the rest are verified on their shingles.

Equal sets are one class and take part once. A part that many sets share is a star around its
smallest document at first. The documents of parts that don't end in one component are looked at
again, tile by tile: all pairs across components that pass the sketches' bound are verified, but
for those that links of the tile have joined meanwhile; so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import Words, chunked, encoded, mix, span_hashes, window_starts
from millrace.llm.frames import bucket_count, text_bytes, tidy, without
from millrace.llm.graph import components
from millrace.llm.marks import BUCKETS_PER_TASK, BUCKET_BYTES, pack, plain, unpack, _batched
from millrace.llm.repeats import one_text_each
from millrace.operators.joins import spread_join
from millrace.session import stage

SHINGLE = 5
#: least Jaccard similarity in hundredths; the bounds below are those of 80
SIMILARITY = 80
LEAST_BAND = 6
#: a sketch has 2 to this power bits for each part of the set's band
SKETCH_BITS = 2
#: documents of one part that are compared in one piece
TILE = 2048
#: and shingles of so many bytes; two tiles meet in a task
TILE_BYTES = 64 << 20


class Sets:
    """The shingle sets of one chunk, a set's hashes rising and distinct."""

    def __init__(self, texts: list[bytes], shingle: int = SHINGLE):
        words = Words([x.lower() for x in texts])
        first, counts = words.first, words.per_text
        starts = window_starts(first, shingle)
        short = np.flatnonzero((counts > 0) & (counts < shingle))
        own = words.hashes()
        hashes = np.concatenate((span_hashes(own, starts, starts + shingle), span_hashes(own, first[short], first[short + 1])))
        text = np.concatenate((np.searchsorted(first, starts, side="right") - 1, short))
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        keep = np.ones(len(hashes), dtype=bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        self.hashes, self.text = hashes[keep], text[keep]
        self.sizes = np.bincount(self.text, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))

    def digests(self) -> np.ndarray:
        """Two 64-bit numbers a set, equal for equal sets."""
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(self.hashes))))
        more = np.concatenate(([np.uint64(0)], np.cumsum(mix(self.hashes ^ np.uint64(0x9E3779B97F4A7C15)))))
        return np.stack([(x[self.first[1:]] - x[self.first[:-1]]) for x in (sums, more)], axis=1)

    def sketches(self) -> list[bytes]:
        """Bit sketches: a shingle flips the bit that its highest bits name."""
        bits = bands(self.sizes) + SKETCH_BITS
        offsets = np.concatenate(([0], np.cumsum(1 << bits)))
        place = (self.hashes >> (64 - bits[self.text]).astype(np.uint64)).astype(np.int64) + offsets[self.text]
        odd = np.packbits((np.bincount(place, minlength=offsets[-1]) & 1).astype(np.uint8)).tobytes()
        return [odd[a // 8 : b // 8] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]

    def keys(self, band: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, key) of the most + 1 first filled parts of each set, in sketches of 2^band
        parts; sets without so many filled parts add their own first shingles likewise."""
        part = (self.hashes >> (64 - band[self.text]).astype(np.uint64)).astype(np.int64)
        new = np.ones(len(part), dtype=bool)
        new[1:] = (part[1:] != part[:-1]) | (self.text[1:] != self.text[:-1])
        heads = np.flatnonzero(new)
        if not len(heads):
            return heads, heads.astype(np.uint64)
        text = self.text[heads]
        held = np.diff(np.append(heads, len(part)))
        key = mix(np.bitwise_xor.reduceat(mix(self.hashes), heads) + band[text].astype(np.uint64))
        poor = np.flatnonzero(np.bincount(text, minlength=len(self.sizes)) <= most)
        few = np.isin(self.text, poor[self.sizes[poor] > 0])
        text = np.concatenate((text, self.text[few] + len(self.sizes)))  # a list of its own
        held = np.concatenate((held, np.ones(int(few.sum()), dtype=held.dtype)))
        key = np.concatenate((key, mix(self.hashes[few] * np.uint64(3) + np.uint64(64))))
        order = np.lexsort((key, -held, text))
        text, key = text[order], key[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        text %= len(self.sizes)
        chosen = rank <= most[text]
        return text[chosen], key[chosen]


def bands(sizes: np.ndarray) -> np.ndarray:
    """The power of two at or below each size."""
    return np.maximum(LEAST_BAND, np.frexp(np.maximum(sizes, 1))[1] - 1).astype(np.int64)


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, size, digest (two longs) and sketch of each document."""
    names = ["doc_id", "size", "digest_a", "digest_b", "sketch"]

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(them):
            texts = encoded(batch.column(1))
            for first, last in chunked(texts):
                sets = Sets(texts[first:last])
                digests = sets.digests().view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(sets.sizes), pa.array(digests[:, 0]),
                     pa.array(digests[:, 1]), pa.array(sets.sketches(), pa.binary())], names=names)

    rows = docs.filter("doc_id is not null").mapInArrow(
        batches, "doc_id long, size long, digest_a long, digest_b long, sketch binary")
    one = F.min(F.struct(*names[1:])).alias("s")
    return rows.groupBy("doc_id").agg(one).select("doc_id", "s.*")


_SENT = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("sent", pa.bool_())])
_MET = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _meetings(docs: DataFrame, size: int) -> DataFrame:
    """Rows (key, a, b): with a null key, a pair of documents that met; else document a of a part
    that several hold. A batch sends the smallest document of each part and settles its others."""
    buckets = bucket_count(docs.sparkSession, BUCKETS_PER_TASK, size, BUCKET_BYTES)

    def send(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(them):
            ids, texts = batch.column(0).to_numpy(), encoded(batch.column(1))
            owners, keys, met = [], [], {}
            for first, last in chunked(texts):
                sets = Sets(texts[first:last])
                # a set that an earlier document of this batch has too takes no part
                new = np.zeros(last - first, dtype=bool)
                for i, digest in enumerate(map(tuple, sets.digests().tolist())):
                    new[i] = sets.sizes[i] > 0 and met.setdefault(digest, first + i) == first + i
                own = bands(sets.sizes)
                low = bands(-(-4 * sets.sizes // 5))
                for band, most, these in ((own, sets.sizes // 4, new), (low, np.minimum(sets.sizes // 4, ((1 << (low + 1)) - 1) // 4), new & (low < own))):
                    text, key = sets.keys(band, most)
                    text, key = text[these[text]], key[these[text]]
                    owners.append(ids[first + text])
                    keys.append(key)
            if not owners:
                continue
            owner, key = np.concatenate(owners), np.concatenate(keys)
            order = np.lexsort((owner, key))
            owner, key = owner[order], key[order]
            head = np.ones(len(key), dtype=bool)
            head[1:] = key[1:] != key[:-1]
            run = np.cumsum(head) - 1
            several = np.bincount(run, minlength=run[-1] + 1 if len(run) else 0)[run] > 1 if len(run) else head
            rows = []
            for sent, take in ((True, head), (False, several)):
                own, k = owner[take], key[take]
                bucket = (k >> np.uint64(32)) % np.uint64(buckets)
                order = np.lexsort((own, bucket) if sent else (own, k, bucket))
                own, k, bucket = own[order], k[order], bucket[order].astype(np.int64)
                edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets)).tolist()
                # sent keys need their bucket and 32 bits more to be told apart
                rows += [(int(bucket[a]), plain(k[a:b], "<u4" if sent else "<u8"), pack(own[a:b], True), sent) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            for at in range(0, len(rows), 256):
                some = rows[at : at + 256]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], f.type) for i, f in enumerate(_SENT)], schema=_SENT)

    def meet(table: pa.Table) -> pa.Table:
        pairs, held = [], []
        for sent in (True, False):
            rows = table.filter(pa.compute.equal(table["sent"], sent))
            if not rows.num_rows:
                continue
            key = np.concatenate([np.frombuffer(x, dtype="<u4" if sent else "<u8") for x in rows["keys"].to_pylist()]).astype(np.uint32)
            own = np.concatenate([unpack(x, "<i8", True) for x in rows["docs"].to_pylist()])
            source = np.zeros(len(own), dtype=np.int64) if sent else np.repeat(np.arange(rows.num_rows), [len(x) // 8 for x in rows["keys"].to_pylist()])
            order = np.lexsort((own, key, source))
            key, own, source = key[order], own[order], source[order]
            head = np.ones(len(key), dtype=bool)
            head[1:] = (key[1:] != key[:-1]) | (source[1:] != source[:-1])
            heads = np.flatnonzero(head)
            run = np.cumsum(head) - 1
            hub = own[heads][run]
            several = np.bincount(run)[run] > 1
            other = several & (own != hub)
            pairs.append(np.stack([hub[other], own[other]], axis=1))
            held.append(np.stack([key[several].astype(np.int64), own[several]], axis=1))
        pair = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        group = np.unique(np.concatenate(held), axis=0) if held else pair
        bucket = table["bucket"][0].as_py()
        return pa.Table.from_arrays(
            [pa.concat_arrays([pa.nulls(len(pair), pa.int64()), pa.array(group[:, 0] + (bucket << 32))]),
             pa.array(np.concatenate((pair[:, 0], group[:, 1]))),
             pa.concat_arrays([pa.array(pair[:, 1]), pa.nulls(len(group), pa.int64())])], schema=_MET)

    sent = docs.filter("doc_id is not null").mapInArrow(send, "bucket int, keys binary, docs binary, sent boolean")
    return sent.groupBy("bucket").applyInArrow(meet, "key long, a long, b long")


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of `size` bytes: neighbouring bits are added modulo 2."""
    bits = np.unpackbits(np.frombuffer(sketch, dtype=np.uint8))
    return np.packbits(bits.reshape(8 * size, -1).sum(axis=1, dtype=np.uint32).astype(np.uint8) & 1)


def _near(sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    low, high = np.minimum(sizes_a, sizes_b), np.maximum(sizes_a, sizes_b)
    return 100 * low >= SIMILARITY * high


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    side = lambda s: sets.select(F.col("doc_id").alias(s), F.col("size").alias(f"size_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        100 * F.least("size_a", "size_b") >= SIMILARITY * F.greatest("size_a", "size_b"))

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            keep = []
            for size_a, size_b, one, two in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4, 5)], strict=True):
                if len(one) != len(two):
                    one, two = (x if len(x) == min(len(one), len(two)) else _folded(x, min(len(one), len(two))).tobytes() for x in (one, two))
                differing = (int.from_bytes(one) ^ int.from_bytes(two)).bit_count()
                keep.append(9 * differing <= size_a + size_b)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return joined.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(tidy(batches), "a long, b long")


def _shingled(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and shingle hashes, rising, of the wanted documents."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(them):
            texts = encoded(batch.column(1))
            for first, last in chunked(texts):
                sets = Sets(texts[first:last])
                raw = [sets.hashes[a:b].tobytes() for a, b in zip(sets.first[:-1].tolist(), sets.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(raw, pa.binary())], names=["doc_id", "shingles"])

    return docs.join(wanted, "doc_id").select("doc_id", "text").mapInArrow(batches, "doc_id long, shingles binary")


def _verified(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def compare(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            keep = []
            for i in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (2, 3))
                both = np.concatenate((one, two))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= SIMILARITY * (len(both) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    side = lambda s: shingles.select(F.col("doc_id").alias(s), F.col("shingles").alias(f"shingles_{s}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "shingles_a", "shingles_b")
    return rows.mapInArrow(tidy(compare), "a long, b long").distinct()


def _apart(met: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(family, node, component): the classes that meet in parts whose documents lie in several
    components. A family is named by the smallest component of a part."""
    members = (
        met.filter("key is not null").select("key", F.col("a").alias("doc_id"))
        .join(classes, "doc_id").select("key", F.col("class").alias("node")).distinct()
        .join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    )
    mixed = (
        members.groupBy("key").agg(F.min("component").alias("family"), F.max("component").alias("_high"))
        .filter("family <> _high").select("key", "family")
    )
    return members.join(mixed, "key").select("family", "node", "component").distinct()


def _tiled(apart: DataFrame, sets: DataFrame, more: DataFrame) -> DataFrame:
    """The nodes of each family with the columns of `more` (by node), once per pair of tiles. A tile
    has about TILE nodes at most and shingles of about TILE_BYTES."""
    sizes = sets.select(F.col("doc_id").alias("node"), "size")
    need = F.greatest(F.count(F.lit(1)) / TILE, F.sum("size") * 8 / TILE_BYTES)
    tiles = apart.join(sizes, "node").groupBy("family").agg(F.ceil(need).cast("int").alias("tiles"))
    return (
        apart.join(tiles, "family").join(more, "node")
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, tiles - 1)")))
        .withColumn("left", F.least("tile", "_other")).withColumn("right", F.greatest("tile", "_other"))
        .drop("_other", "tiles")
    )


def _partners(table: pa.Table, label: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For rows of a pair of tiles in turn, the later rows of other labels that sizes and sketches
    allow to be similar, likelier ones first. Labels may change meanwhile."""
    size, tile = table["size"].to_numpy(), table["tile"].to_numpy()
    raw, band = table["sketch"].to_pylist(), bands(table["size"].to_numpy())
    inner = table["left"][0] == table["right"][0]
    for b in np.unique(band).tolist():
        # sets of this band, and those of the next that may be near one of this
        here, width = np.flatnonzero(band == b), (1 << (b + SKETCH_BITS)) // 8
        both = np.concatenate((here, np.flatnonzero((band == b + 1) & (SIMILARITY * size < 100 << (b + 1)))))
        lines = np.stack([_folded(raw[i], width) if len(raw[i]) > width else np.frombuffer(raw[i], dtype=np.uint8) for i in both.tolist()]).view(np.uint64)
        for at in range(len(here)):
            i, rest = both[at], both[at + 1 :]
            ok = _near(size[i], size[rest]) & (label[i] != label[rest])
            if not inner:
                ok &= tile[i] != tile[rest]
            left = np.flatnonzero(ok)
            if len(left):
                differing = np.bitwise_count(lines[at + 1 + left] ^ lines[at]).sum(axis=1, dtype=np.int64)
                order = np.argsort(differing, kind="stable")
                left = left[order[9 * differing[order] <= size[i] + size[rest[left[order]]]]]
                if len(left):
                    yield int(i), rest[left]


def _active(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of apart that may be similar to one of another component."""
    sketched = sets.select(F.col("doc_id").alias("node"), "size", "sketch")

    def look(table: pa.Table) -> pa.Table:
        hit = np.zeros(table.num_rows, dtype=bool)
        for i, others in _partners(table, np.unique(table["component"].to_numpy(), return_inverse=True)[1]):
            hit[i] = True
            hit[others] = True
        return table.select(["family", "node", "component"]).filter(pa.array(hit))

    return _tiled(apart, sets, sketched).groupBy("family", "left", "right").applyInArrow(
        look, "family long, node long, component long").distinct()


def _across(apart: DataFrame, sets: DataFrame, shingles: DataFrame) -> DataFrame:
    """Links (a, b) between components within families, as many as join them: per tile a forest."""
    held = sets.select(F.col("doc_id").alias("node"), "size", "sketch").join(shingles.withColumnRenamed("doc_id", "node"), "node")

    def compare(table: pa.Table) -> pa.Table:
        size, node = table["size"].to_numpy(), table["node"].to_numpy()
        label = np.unique(table["component"].to_numpy(), return_inverse=True)[1]
        items = [np.frombuffer(x, dtype=np.uint64) for x in table["shingles"].to_pylist()]
        links = []
        for i, others in _partners(table, label):
            for j in others.tolist():
                if label[i] == label[j]:
                    continue
                found = np.searchsorted(items[i], items[j])
                shared = int((items[i][np.minimum(found, len(items[i]) - 1)] == items[j]).sum())
                if 100 * shared >= SIMILARITY * (size[i] + size[j] - shared):
                    links.append((min(node[i], node[j]), max(node[i], node[j])))
                    label[label == label[j]] = label[i]
        pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return _tiled(apart, sets, held).groupBy("family", "left", "right").applyInArrow(compare, "a long, b long").distinct()


def link_similar(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach, a row for each
    row of docs (doc_id, text).

    Texts have A-Z lower-cased; a set is the distinct shingles of SHINGLE words, or all words as
    one where there are fewer. Two documents link if the intersection is at least SIMILARITY
    hundredths of the union. A null or empty text, or one without words, links with nothing: it is
    a component of its own. Rows without a doc_id have no component (null) and no shingles (null).
    Rows that share a doc_id count as one document, whose text is the first of theirs in byte order, and
    get one result. Texts have any length; one is held whole by a task. An empty table gives an
    empty table. The rows must come in the same order if they are read again: from a table.
    """
    docs = without(docs, "n_shingles", "component_id")
    texts = one_text_each(docs.select("doc_id", "text"))
    sets = stage(_sets(texts), "similar-sets")
    own = ["digest_a", "digest_b", "size"]
    by_set = stage(sets.filter("size > 0").groupBy(*own).agg(F.min("doc_id").alias("class"), F.count(F.lit(1)).alias("n")), "similar-classes")
    # a set that very many documents have is dealt
    classes = stage(spread_join(sets.select(*own, "doc_id"), by_set.select(*own, "class"), own, ["doc_id"], by_set.select(*own, "n"))
                    .select("doc_id", "class"), "similar-classes")
    met = stage(_meetings(texts, text_bytes(texts)), "similar-meetings")
    pairs = met.filter("key is null").select("a", "b").distinct()
    pairs = (
        pairs.join(classes.select(F.col("doc_id").alias("a"), F.col("class").alias("_a")), "a")
        .join(classes.select(F.col("doc_id").alias("b"), F.col("class").alias("_b")), "b")
        .filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
    )
    possible = stage(_possible(pairs, sets), "similar-possible")
    ends = possible.select(F.col("a").alias("doc_id")).unionByName(possible.select(F.col("b").alias("doc_id"))).distinct()
    links = stage(_verified(possible, stage(_shingled(texts, ends), "similar-shingles")), "similar-links")
    labels = stage(components(links), "similar-labels")
    apart = stage(_active(_apart(met, classes, labels), sets), "similar-apart")
    if not apart.isEmpty():
        ends = apart.select(F.col("node").alias("doc_id")).distinct()
        more = stage(_across(apart, sets, _shingled(texts, ends)), "similar-across")
        labels = components(links.unionByName(more))
    found = (
        sets.select("doc_id", "size").join(classes, "doc_id", "left")
        .join(labels.withColumnRenamed("node", "class"), "class", "left")
        .select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "class", "doc_id").alias("component_id"))
    )
    return docs.select("doc_id").join(found, "doc_id", "left")
