"""Benchmark decontamination with one Aho-Corasick automaton.

The automaton holds the windows of all test items, normalised: words (runs of digits, letters
a-z and characters outside ASCII, A-Z lower-cased) joined by single blanks. Each text is
normalised alike and scanned once; matches map back to words and to code points of the text.

A window is `width` consecutive words of an item; an item of fewer words is one window, an item
without words none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.frames import tidy, widened, without
from millrace.session import stage

WIDTH = 10
#: bytes of window text that one automaton holds; a node a byte at most, about 50 bytes each
AUTOMATON_BYTES = 1 << 22
_RESULT = "n_words long, n_hit long, item_ids array<string>, hit_spans array<struct<start:long,end:long>>"
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def normalised(text: str | None) -> bytes:
    """The words, each between blanks."""
    words = (text or "").encode().translate(_FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b""


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(window, items): each distinct window with its distinct items' ids as strings."""
    words = F.expr(
        r"filter(split(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), w -> w <> '')"
    )
    window = F.explode(F.expr(
        f"transform(sequence(1, greatest(size(words) - {width} + 1, 1)),"
        f" i -> array_join(slice(words, i, {width}), ' '))"
    ))
    return (
        items.select(F.col("item_id").cast("string").alias("item"), words.alias("words"))
        .filter("size(words) > 0 and item is not null")
        .select("item", window.alias("window"))
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _automaton(windows: list[tuple[str, tuple[str, ...]]], name: str) -> ahocorasick.Automaton:
    """A worker builds it once. It reads UTF-8 as Latin-1, so that places are byte places."""
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        built = ahocorasick.Automaton()
        for window, items in windows:
            raw = f" {window} ".encode()
            built.add_word(raw.decode("latin-1"), (len(raw), items))
        built.make_automaton()
        _AUTOMATA[name] = built
    return _AUTOMATA[name]


def _code_point_spans(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of words (first, last) as spans of code points of the text."""
    folded = np.frombuffer(text.encode().translate(_FOLD), dtype=np.uint8)
    inside = np.zeros(len(folded) + 2, dtype=np.int8)
    inside[1:-1] = folded != 0x20
    turns = np.flatnonzero(np.diff(inside))
    points = np.concatenate(([0], np.cumsum((folded & 0xC0) != 0x80)))
    return [{"start": int(points[turns[2 * a]]), "end": int(points[turns[2 * b + 1]])} for a, b in runs]


def _scan(docs: DataFrame, windows: list[tuple[str, tuple[str, ...]]]) -> tuple[DataFrame, Broadcast]:
    spark = docs.sparkSession
    name = hashlib.sha256(repr(windows).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(windows)
    names = [*docs.columns, "n_words", "n_hit", "item_ids", "hit_spans"]
    schema = widened(docs.schema, _RESULT)
    place = docs.columns.index("text")
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()),
             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _AUTOMATA[name] if name in _AUTOMATA else _automaton(sent.value, name)
        scan = automaton.iter if len(automaton) else lambda _: ()
        for batch in them:
            rows = []
            for text in batch.column(place).to_pylist():
                raw = normalised(text)
                total = max(raw.count(b" ") - 1, 0)
                found = list(scan(raw.decode("latin-1"))) if total else []
                if not found:
                    rows.append((total, 0, [], []))
                    continue
                blanks = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 0x20)
                turns = np.zeros(total + 1, dtype=np.int64)
                items: set[str] = set()
                for end, (size, its) in found:
                    first, last = np.searchsorted(blanks, (end - size + 1, end))
                    turns[first] += 1
                    turns[last] -= 1
                    items.update(its)
                hit = np.concatenate(([0], np.cumsum(turns[:-1]) > 0, [0])).astype(np.int8)
                edges = np.flatnonzero(np.diff(hit))
                runs = [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]
                rows.append((total, int(hit.sum()), sorted(items), _code_point_spans(text, runs)))
            own = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=names)

    return docs.mapInArrow(tidy(batches), schema), sent


def _gathered(windows: DataFrame, parts: int, part: int) -> list[tuple[str, tuple[str, ...]]]:
    own = windows.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
    return sorted((w, tuple(its)) for w, its in own.collect())


def _in_parts(docs: DataFrame, windows: DataFrame, parts: int) -> DataFrame:
    """One job a part of the windows, one part at a time on the driver and in the workers; each writes
    the hits of the documents that it hits. These are added up per document in the end."""
    windows = stage(windows, "benchmark-windows")
    numbered = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "benchmark-documents")
    hits = []
    for part in range(parts):
        scanned, sent = _scan(numbered.select("_row", "text"), _gathered(windows, parts, part))
        hits.append(stage(scanned.filter("n_hit > 0").select("_row", "item_ids", "hit_spans"), "benchmark-hits"))
        sent.destroy()
    union = hits[0]
    for more in hits[1:]:
        union = union.unionByName(more)
    # a document has at most a row a part
    merged = union.groupBy("_row").agg(*[
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(f"_{c}") for c in ("item_ids", "hit_spans")])
    counted, _ = _scan(numbered, [])
    kept = [F.col(f"`{c}`") for c in docs.columns]
    both = [F.coalesce(f"_{c}", F.col(c)).alias(c) for c in ("item_ids", "hit_spans")]
    found = counted.join(merged, "_row", "left").select(*kept, "n_words", *both)
    return found.select(*kept, "n_words", _words_in_spans(F.col("text"), F.col("hit_spans")).alias("n_hit"), "item_ids", "hit_spans")


def _words_in_spans(text: Column, spans: Column) -> Column:
    """Words of the text in the union of spans, which may overlap but are sorted by start."""
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:long,end:long>>"),
        lambda held, s: F.when(
            (F.size(held) > 0) & (F.element_at(held, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(held, 1, F.size(held) - 1),
                F.array(F.struct(F.element_at(held, -1)["start"].alias("start"),
                                 F.greatest(F.element_at(held, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(held, F.array(s))),
    )
    words = F.transform(merged, lambda s: F.regexp_count(
        F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")),
        F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))  # the text's own capitals too
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, b: a + b)


def find_contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` with n_words, n_hit (long), item_ids (the items of which a window occurs) and
    hit_spans (code points from start to end, of runs of hit words). Columns that already have
    these names are replaced.

    A null text has no words. Rows that repeat are scanned alike; items that repeat, or have no
    item_id or words, add nothing. An empty table gives an empty table, an empty set of items
    no hits.

    Texts have any length; one is held whole by a task. The test set's windows are gathered as
    long as one automaton's bound holds them; a larger test set is scanned in several parts one
    after the other, each with an automaton within the bound, with the same results but for the
    spans, of which parts may give overlapping ones.
    """
    docs = without(docs, "n_words", "n_hit", "item_ids", "hit_spans", "_item_ids", "_hit_spans", "_row")
    windows = item_windows(items, width)
    size = windows.agg(F.coalesce(F.sum(F.octet_length("window") + 2), F.lit(0))).first()[0]
    count = max(1, -(-int(size) // AUTOMATON_BYTES))
    if count > 1:
        return _in_parts(docs, windows, count)
    return _scan(docs, _gathered(windows, 1, 0))[0]
