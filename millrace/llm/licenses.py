"""License scans: exact phrases, and an exact join of text blocks with license notices.

A notice of n words is looked for in blocks of the least power of two words that is at least 2 n,
one at every half of that, so that any n words in a row lie within one. A block meets a notice if it holds
at least `threshold` of the notice's distinct words. The join finds every such pair:

* words are ordered by how often all documents use them, the rarest first;
* a notice of m words of which `need` must be met shows one of its first m - need + 1 words in every
  block that meets it (prefix), and such a block shows it among all but its last need - 1;
* a block must have `need` words (length), and from the first word that both share as many must
  follow in both (position);
* what is left is counted.

Words that no notice has add nothing and are left out of the blocks. The notices' words are the
only thing that is broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import encoded
from millrace.llm.frames import widened, without
from millrace.session import stage

THRESHOLD = 0.9
#: words of all notices together; more are refused, since every task holds them
MAX_WORDS = 1 << 20

# The phrases with their labels.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Usual notices, in lower case, with their labels.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("agpl-3.0", "under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("cc-by-4.0", "under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: A-Z to a-z, all separators to blanks, other bytes as they are
_TO_WORDS = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_TO_WORDS = _TO_WORDS[:0x41] + bytes(range(0x61, 0x7B)) + _TO_WORDS[0x5B:]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def block_words(n: int) -> int:
    """Words of a block in which a notice of n words is looked for."""
    return max(2, 1 << (2 * n - 1).bit_length())


def needed(n: int, threshold: float) -> int:
    """How many of n distinct words must be met."""
    return max(1, -(-round(n * threshold * 1_000_000) // 1_000_000))


@dataclass
class Notice:
    label: str
    width: int
    #: its distinct words' ranks, rising
    ranks: list[int]
    need: int

    @property
    def prefix(self) -> list[int]:
        return self.ranks[: len(self.ranks) - self.need + 1]


def _vocabulary(phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> list[bytes]:
    found = sorted({w for _, text in [*phrases, *notices] for w in words_of(text.encode())})
    if len(found) > MAX_WORDS:
        raise ValueError(f"notices of more than {MAX_WORDS} distinct words")
    return found


def word_ranks(docs: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """The order of the vocabulary, the rarest in all whole texts first, equally frequent ones by
    their bytes. Tasks send one row a word at most."""
    numbers = {w: k for k, w in enumerate(vocabulary)}

    def count(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in them:
            for text in encoded(batch.column(0)):
                total.update(filter(numbers.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([numbers[w] for w in total], pa.int32()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = docs.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    sizes = {r["word"]: r["n"] for r in counted.collect()}  # a row a word of the vocabulary
    order = sorted(range(len(vocabulary)), key=lambda k: (sizes.get(k, 0), k))
    return {vocabulary[k]: rank for rank, k in enumerate(order)}


def ranked_notices(notices: list[tuple[str, str]], ranks: dict[bytes, int], threshold: float) -> list[Notice]:
    out = []
    for label, text in notices:
        words = words_of(text.encode())
        if not words:
            raise ValueError(f"the notice of {label} has no word")
        own = sorted({ranks[w] for w in words})
        out.append(Notice(label, block_words(len(words)), own, needed(len(own), threshold)))
    return out


_BLOCK = pa.list_(pa.struct([("width", pa.int32()), ("first", pa.int64()), ("ranks", pa.list_(pa.int32()))]))
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("size", pa.int32())]))


def _phrase_places(words: list[bytes], at: list[int], phrases: dict[bytes, list[tuple[str, list[bytes]]]]) -> list[dict]:
    """Every place of every phrase. at: the places of words that some phrase or notice has."""
    return [
        {"label": label, "first": k, "size": len(phrase)}
        for k in at if words[k] in phrases
        for label, phrase in phrases[words[k]] if words[k : k + len(phrase)] == phrase
    ]


def _blocks(at: np.ndarray, ranks: np.ndarray, total: int, by_width: dict[int, np.ndarray]) -> list[dict]:
    """The blocks of one text that show a prefix word of a notice, with their ranks, rising."""
    out = []
    for width, wanted in by_width.items():
        half = width // 2
        shown = np.unique(at[np.isin(ranks, wanted)] // half)
        numbers = np.unique(np.concatenate((shown, shown - 1)))
        for k in numbers[(numbers >= 0) & ((numbers == 0) | (numbers * half + half < total))].tolist():
            a, b = np.searchsorted(at, (k * half, k * half + width))
            out.append({"width": width, "first": k * half, "ranks": np.unique(ranks[a:b]).tolist()})
    return out


def _scanned(docs: DataFrame, ranks: dict[bytes, int], phrases: list[tuple[str, str]], notices: list[Notice]) -> DataFrame:
    """docs less text, with _row, n_words, base and _blocks."""
    by_first: dict[bytes, list] = {}
    for label, text in phrases:
        words = words_of(text.encode())
        by_first.setdefault(words[0], []).append((label, words))
    by_width: dict[int, set[int]] = {}
    for notice in notices:
        by_width.setdefault(notice.width, set()).update(notice.prefix)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, by_first, {w: np.array(sorted(x)) for w, x in by_width.items()}))
    names = [c for c in docs.columns if c != "text"]
    place, others = docs.columns.index("text"), [docs.columns.index(c) for c in names]

    def scan(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, by_first, by_width = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in them:
            sizes, bases, blocks = [], [], []
            for text in encoded(batch.column(place)):
                words = words_of(text)
                at = [k for k, known in enumerate(map(ranks.__contains__, words)) if known]
                found = np.fromiter((ranks[words[k]] for k in at), dtype=np.int32, count=len(at))
                sizes.append(len(words))
                bases.append(_phrase_places(words, at, by_first))
                blocks.append(_blocks(np.array(at, dtype=np.int64), found, len(words), by_width))
            more = [pa.array(range(row, row + batch.num_rows), pa.int64()), pa.array(sizes, pa.int64()), pa.array(bases, _PLACES), pa.array(blocks, _BLOCK)]
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in others], *more], names=[*names, "_row", "n_words", "base", "_blocks"])

    kind = ("_row long, n_words long, base array<struct<label:string,first:long,size:int>>, "
            "_blocks array<struct<width:int,first:long,ranks:array<int>>>")
    return docs.mapInArrow(scan, widened(docs.select(*[f"`{c}`" for c in names]).schema, kind))


def meeting_blocks(blocks: DataFrame, notices: list[Notice]) -> DataFrame:
    """(_row, label, first, width, score): the blocks (_row, width, first, ranks) that meet a notice,
    by prefix, length, position and then by count."""
    spark = blocks.sparkSession
    rows = [(n.label, n.width, n.ranks, n.need, i, rank) for n in notices for i, rank in enumerate(n.prefix)]
    postings = F.broadcast(spark.createDataFrame(rows, "label string, width int, own array<int>, need int, i int, rank int"))
    least = {n.width: min(m.need for m in notices if m.width == n.width) for n in notices}
    need = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("width")]
    size = F.size("ranks")
    shown = (
        blocks.filter(size >= need)
        .select("_row", "width", "first", "ranks", F.posexplode(F.slice("ranks", F.lit(1), size - need + 1)).alias("j", "rank"))
        .join(postings, ["width", "rank"])
        .filter((size >= F.col("need")) & (F.least(F.size("own") - F.col("i"), size - F.col("j")) >= F.col("need")))
        # of the words that both share the first, so a block meets a notice once
        .filter(~F.arrays_overlap(F.slice("ranks", F.lit(1), F.col("j")), F.slice("own", F.lit(1), F.col("i"))))
    )
    common = F.size(F.array_intersect("ranks", "own"))
    return (
        shown.withColumn("common", common).filter("common >= need")
        .select("_row", "label", "first", "width", (F.col("common") / F.size("own")).alias("score"))
    )


def scan_licenses(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, phrases: list[tuple[str, str]] = PHRASES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """`docs` (doc_id, text, any others) less text, with n_words (long), base (the places of phrases:
    label, first word, size), met (the blocks that meet notices: label, first word, size, score),
    base_labels and labels (sorted, the latter of both) and score: 1 with a phrase, else the largest share
    of a notice that a block holds, of those that reach the threshold, else 0. Columns with these
    names are replaced.

    Words are those of the whole text in lower case, whatever its length; a null text has none. Rows
    are judged one by one, also those that share a doc_id or have none, and equal rows alike. Equally
    frequent words stand by their bytes, which changes no result. An empty table gives an empty
    table. The rows are read twice: give a table.
    """
    docs = without(docs, "n_words", "base", "met", "base_labels", "labels", "score", "_row", "_blocks")
    ranks = word_ranks(docs, _vocabulary(phrases, notices))
    ranked = ranked_notices(notices, ranks, threshold)
    scanned = stage(_scanned(docs, ranks, phrases, ranked), "licenses")
    blocks = scanned.select("_row", F.inline("_blocks"))
    met = meeting_blocks(blocks, ranked).groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("label", "first", F.col("width").alias("size"), "score"))).alias("met"))
    none = F.array().cast("array<struct<label:string,first:long,size:int,score:double>>")
    joined = scanned.drop("_blocks").join(met, "_row", "left").withColumn("met", F.coalesce("met", none))
    base = F.array_sort(F.array_distinct("base.label"))
    best = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("met.score"), F.lit(0.0)))
    return joined.drop("_row").withColumns({
        "base_labels": base, "labels": F.array_sort(F.array_union("base.label", "met.label")), "score": best})
