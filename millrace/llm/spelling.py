"""Spelling variants: frequent words one edit apart, found by k-d trees over letter counts.

A replaced letter leaves a word's length and moves one count up and one down; an inserted letter
moves one count up. So near words are at most two apart in the sum of the differences of their
letter counts, and a range search of a k-d tree finds them; the order of the letters is looked at
last. Words are dealt by length and by the cells of a coarse tree per length; a word also visits the
cells of its own and of the next length whose box it could reach. Each cell has a tree of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.frames import task_count
from millrace.llm.kdtree import KdTree
from millrace.operators.joins import spread_join
from millrace.session import stage

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
SLIP_EVERY = 199
#: words of one length that share a cell, about
CELL_WORDS = 16384
#: words of a length on which its coarse tree is fitted; it only says how words are dealt
SAMPLE_WORDS = 16384
#: a group gets so many shorter words, at their mean, per word that a cell should have
QUERIES_PER_WORD = 8
#: points of a leaf of a cell's own tree
LEAF_POINTS = 24
#: pairs looked at together, and queries searched together
STEP_PAIRS = 1 << 20
STEP_QUERIES = 1 << 14
_LETTERS = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a-z and U+00C0 to U+00FF each have a place; U+0041 to U+005A don't occur in words
_AXES = 26 + 64


# --- words -------------------------------------------------------------------------------------

def with_slip(doc_id: Column, run: Column, every: int = SLIP_EVERY) -> Column:
    """The run, less one letter where the crc32 of `<doc_id>:<run>` is a multiple of `every`."""
    draw = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    at = (draw % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(draw % every == 0, cut).otherwise(run)


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = SLIP_EVERY) -> DataFrame:
    """(word, n): the words of all whole texts with at least `min_length` letters and `min_count`
    places, A-Z lower-cased, each run changed as `with_slip` says. A run of a row without a
    doc_id is not changed. Counts are added up in every task before the shuffle."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{_LETTERS}{{{min_length},}}"), F.lit(0))).alias("run"))
    lowered = runs.select("doc_id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run")).alias("run"))
    words = lowered.select(with_slip(F.col("doc_id"), F.col("run"), every).alias("word")).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# --- vectors and letters -----------------------------------------------------------------------

def letter_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points one after another, and where each word begins (and the last ends)."""
    joined = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    return joined, np.concatenate(([0], ends))


def letter_counts(joined: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of letter counts a word, cut off at 255, which brings no two words further apart."""
    n = len(first) - 1
    place = np.where(joined < 0xC0, joined - 0x61, joined - 0xC0 + 26).astype(np.int64)
    out = np.zeros((n, _AXES), dtype=np.uint8)
    step = max(1, STEP_PAIRS // _AXES)
    for a in range(0, n, step):
        b = min(n, a + step)
        own = np.repeat(np.arange(b - a), np.diff(first[a : b + 1]))
        flat = np.bincount(own * _AXES + place[first[a] : first[b]], minlength=(b - a) * _AXES)
        out[a:b] = np.minimum(flat, 255).reshape(b - a, _AXES)
    return out


def _parities(counts: np.ndarray) -> np.ndarray:
    """Odd counts as bits, folded into 64: they differ in at most as many bits as counts do."""
    odd = (counts & 1).astype(bool)
    odd[:, :26] ^= odd[:, 64:]
    return np.packbits(odd[:, :64], axis=1).view(np.uint64).ravel()


def one_edit(joined: np.ndarray, first: np.ndarray, short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether word `long` is word `short` with one letter replaced (equal lengths) or inserted."""
    size, other = first[short + 1] - first[short], first[long + 1] - first[long]
    low, high = first[short], first[long]
    fore = np.zeros(len(short), dtype=np.int64)  # letters that agree from the front
    live = np.arange(len(short))
    while len(live):
        live = live[fore[live] < size[live]]
        live = live[joined[low[live] + fore[live]] == joined[high[live] + fore[live]]]
        fore[live] += 1
    # what follows the changed letter must agree to the end
    rest = size - fore - (other == size)
    good = rest >= 0
    done, live = np.zeros(len(short), dtype=np.int64), np.flatnonzero(good)
    while len(live):
        live = live[done[live] < rest[live]]
        same = joined[low[live] + size[live] - 1 - done[live]] == joined[high[live] + other[live] - 1 - done[live]]
        good[live[~same]] = False
        live = live[same]
        done[live] += 1
    return good


# --- the search --------------------------------------------------------------------------------

@dataclass
class Dealing:
    """trees: per length with more words than a cell should have, its coarse tree, without points.
    pieces: per length, if more than one, over how many groups a cell deals the shorter queries."""

    trees: dict[int, KdTree]
    pieces: dict[int, int]


def plan_dealing(words: DataFrame, cell_words: int = CELL_WORDS) -> Dealing:
    """Trees of lengths with more than `cell_words` words, with about a leaf for so many, fitted on
    about SAMPLE_WORDS of the words. There are fewer such lengths than words / cell_words."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_words)
    counts = {r["length"]: r["n"] for r in sizes.collect()}
    if not counts:
        return Dealing({}, {})
    step = F.create_map(*[F.lit(x) for length, n in counts.items() for x in (length, -(-n // SAMPLE_WORDS))])
    chosen = words.filter(F.length("word").isin(list(counts))).filter(F.pmod(F.xxhash64("word"), step[F.length("word")]) == 0)
    sampled: dict[int, list[str]] = {}
    for r in chosen.select("word").collect():
        sampled.setdefault(len(r["word"]), []).append(r["word"])
    trees = {
        length: KdTree.build(letter_counts(*letter_rows(sorted(own))), max(1, cell_words * len(own) // counts[length])).bare()
        for length, own in sampled.items()
    }
    leaves = {length + 1: trees[length + 1].leaves if length + 1 in trees else 1 for length in counts}
    pieces = {length: -(-counts[length - 1] // (QUERIES_PER_WORD * cell_words * n)) for length, n in leaves.items()}
    return Dealing(trees, {length: n for length, n in pieces.items() if n > 1})


_DEALT = pa.schema([("length", pa.int32()), ("cell", pa.int32()), ("piece", pa.int32()), ("kind", pa.int8()), ("word", pa.string()), ("n", pa.int64())])
#: a point that is a query too, a query of the length, a shorter query, a point for shorter ones only
_HOME, _SAME, _SHORTER, _POINT = range(4)


def _dealt(words: DataFrame, dealing: Dealing) -> DataFrame:
    """Each word in its own cell, in later cells of its length and in cells of the next length that
    may hold near words."""
    shared = words.sparkSession.sparkContext.broadcast(dealing)

    def deal(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, pieces = shared.value.trees, shared.value.pieces
        for batch in them:
            own = batch.column(0).to_pylist()
            lengths = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                counts = None
                if length in trees or length + 1 in trees:
                    counts = letter_counts(*letter_rows([own[i] for i in at.tolist()]))
                home = np.zeros(len(at), dtype=np.int64)
                parts = []
                if length in trees:
                    query, home[:] = (x[0] for x in _ordered(*trees[length].search(counts, 0, 0)))
                    query, cell = trees[length].search(counts, 1, 1)
                    later = cell > home[query]
                    parts.append((length, cell[later], 0, _SAME, query[later]))
                every = np.arange(len(at))
                query, cell = trees[length + 1].search(counts, 1, 0) if length + 1 in trees else (every, home * 0)
                piece = np.array([zlib.crc32(own[i].encode()) for i in at.tolist()])[query] % pieces.get(length + 1, 1)
                parts += [(length + 1, cell, piece, _SHORTER, query), (length, home, 0, _HOME, every)]
                parts += [(length, home, k, _POINT, every) for k in range(1, pieces.get(length, 1))]
                for to, cell, piece, kind, query in parts:
                    whole = np.zeros(len(query), dtype=np.int64)
                    keys = [whole + to, cell, whole + piece, whole + kind]
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(x.astype(t)) for x, t in zip(keys, ("i4", "i4", "i4", "i1"), strict=True)],
                         *batch.take(pa.array(at[query])).columns], schema=_DEALT)

    return words.select("word", "n").mapInArrow(deal, "length int, cell int, piece int, kind byte, word string, n long")


def _ordered(query: np.ndarray, cell: np.ndarray):
    order = np.argsort(query, kind="stable")
    return (query[order],), (cell[order],)


def near_pairs(words: list[str], kinds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, point) of near words in a cell, each once; a point that is a query meets only
    points after it."""
    points = np.flatnonzero((kinds == _HOME) | (kinds == _POINT))
    if not len(points):
        return
    joined, first = letter_rows(words)
    counts = letter_counts(joined, first)
    bits = _parities(counts)
    tree = KdTree.build(counts[points], LEAF_POINTS)
    by_leaf = points[np.argsort(tree.leaf, kind="stable")]
    sizes = np.bincount(tree.leaf, minlength=tree.leaves)
    begins = np.cumsum(sizes) - sizes
    for shorter in (False, True):
        queries = np.flatnonzero(kinds == _SHORTER if shorter else (kinds == _HOME) | (kinds == _SAME))
        reach = 1 if shorter else 2
        for k in range(0, len(queries), STEP_QUERIES):
            own = queries[k : k + STEP_QUERIES]
            query, leaf = tree.search(counts[own], 1, 0 if shorter else 1)
            query = own[query]
            done = np.cumsum(sizes[leaf])
            a = 0
            while a < len(leaf):
                b = max(a + 1, int(np.searchsorted(done, done[a] + STEP_PAIRS)))
                size = sizes[leaf[a:b]]
                left = np.repeat(query[a:b], size)
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                right = by_leaf[np.repeat(begins[leaf[a:b]], size) + step]
                a = b
                if not shorter:
                    keep = (kinds[left] == _SAME) | (left < right)
                    left, right = left[keep], right[keep]
                keep = np.bitwise_count(bits[left] ^ bits[right]) <= reach
                left, right = left[keep], right[keep]
                apart = np.abs(counts[left].astype(np.int16) - counts[right]).sum(axis=1)
                # equal counts in equal lengths are no replaced letter
                keep = apart == reach if counts.max(initial=0) < 255 else apart <= reach
                left, right = left[keep], right[keep]
                keep = one_edit(joined, first, left, right)
                if keep.any():
                    yield left[keep], right[keep]


_FOUND = "word string, n long, n_near long, score long, best string"


def _search(dealt: DataFrame) -> DataFrame:
    """Per cell and word: n (in its own cell, else 0), near words found here, and the best of them."""

    def search(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()
        words, n = table["word"].to_pylist(), table["n"].to_numpy()
        pairs = list(near_pairs(words, kinds))
        home = np.flatnonzero(kinds == _HOME)
        out = [(np.array(home), n[home], np.zeros(len(home), np.int64), np.zeros(len(home), np.int64), np.full(len(home), -1))]
        if pairs:
            left, right = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
            own, other = np.concatenate((left, right)), np.concatenate((right, left))
            involved, place = np.unique(other, return_inverse=True)
            rank = np.empty(len(involved), dtype=np.int64)
            rank[sorted(range(len(involved)), key=lambda i: words[involved[i]])] = np.arange(len(involved))
            order = np.lexsort((rank[place], -n[other], own))
            own, other = own[order], other[order]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            counts = np.diff(np.append(heads, len(own)))
            out.append((own[heads], np.zeros(len(heads), np.int64), counts, -n[other[heads]], other[heads]))
        who, count, near, score, best = (np.concatenate([o[i] for o in out]) for i in range(5))
        return pa.table({
            "word": table["word"].take(pa.array(who)), "n": count, "n_near": near, "score": score,
            "best": table["word"].take(pa.array(best, mask=best < 0)),
        })

    # as many tasks as there are partitions, however few bytes the words have: the search is the work
    keys = ["length", "cell", "piece"]
    return dealt.repartition(task_count(dealt.sparkSession), *keys).groupBy(*keys).applyInArrow(search, _FOUND)


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, n_near, best_n, best): for each of `words` (word, n; each word once) how many others
    are one inserted, deleted or replaced letter away, and the most frequent of these (the first in
    code-point order of equally frequent ones). `words` is read more than once: give a table."""
    found = _search(_dealt(words, plan_dealing(words, cell_words)))
    low = F.min(F.when(F.col("best").isNotNull(), F.struct("score", "best")))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), low.alias("low")).select(
        "word", "n", "n_near", (-F.col("low.score")).alias("best_n"), F.col("low.best").alias("best"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for each row of `forms` (word, form; each word once, no cycles): the word at which
    the forms end. Every round doubles the steps taken. A form of very many words is dealt."""
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while not now.isEmpty():
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stage(
            spread_join(now, further, ["root"], ["word"], how="left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            break
    return now


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                   every: int = SLIP_EVERY, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root): every frequent word of `docs` (doc_id, text; other columns
    take no part), its near word of largest n where that is `ratio` times its own or more, and the word
    at which its forms end, or itself.

    Null texts have no words. Rows without a doc_id count with their runs unchanged. Repeated rows
    count each. Ties go to the smallest word in code-point order. Texts and words may have any
    length; a word's letters are counted whole, each count cut off at 255, and compared whole. An empty
    table, or one without frequent words, gives an empty table.
    """
    words = stage(count_words(docs, min_length, min_count, every), "spelling-words")
    near = near_words(words, cell_words)
    chosen = F.col("best_n") >= ratio * F.col("n")
    judged = stage(near.select(
        "word", "n", "n_near", F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n")),
        "spelling-forms")
    roots = follow_forms(judged.filter("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
