from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import spelling
from millrace.llm.kdtree import KdTree
from millrace.llm.spelling import group_variants
from millrace.session import stage

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def counted(rows, min_length=6, min_count=5, every=199):
    found: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.FOLD)
            draw = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and draw % every == 0:
                at = draw % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= min_length and n >= min_count}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(n, ratio=5):
    out, forms = {}, {}
    for w in n:
        others = [o for o in n if abs(len(o) - len(w)) <= 1 and near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            forms[w] = best
        out[w] = (n[w], len(others), forms.get(w), n[best] if w in forms else None)
    for w in out:
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (*out[w], root)
    return out


def check(frame, want, **options):
    found = group_variants(frame, **options).collect()
    assert len({r["word"] for r in found}) == len(found)
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in found} == want


@pytest.mark.parametrize("which", ["made_frame", "small"])
def test_variants(which, request):
    frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    want = plain(counted(rows, 5, 3))
    assert any(x[2] for x in want.values()) or which == "made_frame"
    check(frame, want, min_length=5, min_count=3)
    check(frame, plain(counted(rows)))


def test_chains_cells_and_pieces(spark):
    """Words of few letters, so that many are near, in small cells with dealt queries; a word that is
    the form of very many."""
    rng = random.Random(8)
    words: Counter = Counter()
    for length, many in ((6, 900), (7, 60), (8, 200)):
        for _ in range(many):
            words["".join(rng.choices("abcÿ", k=length))] += rng.choice([1, 1, 2, 7, 40])
    hub = "zzzzzzzz"
    words[hub] = 3000
    words.update({hub[:k] + c + hub[k + 1 :]: 2 for k in range(8) for c in "abcdefghijklmnopqrstuvwxy"})
    words.update({"chain" + "x" * k: 5 ** (k - 1) for k in range(1, 6)})
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    frame = stage(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "spelling-test")
    want = plain(counted(rows, 6, 1, 3))
    assert max(len([1 for x in want.values() if x[2] == w]) for w in want) > 100
    check(frame, want, min_count=1, every=3, cell_words=40)
    assert len(spelling.plan_dealing(spelling.count_words(frame, 6, 1, 3), 40).trees) >= 3


def test_many_words_meet_few_longer_ones(spark):
    """Shorter queries of a small cell are dealt over several groups."""
    rng = random.Random(9)
    words = {"".join(rng.choices("abcd", k=6)) for _ in range(900)}
    words |= {w[:3] + "e" + w[3:] for w in sorted(words)[:30]}
    rows = list(enumerate(sorted(words)))
    frame = stage(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "spelling-test")
    assert spelling.plan_dealing(spelling.count_words(frame, 6, 1, 1 << 40), 40).pieces == {7: 3}
    check(frame, plain(counted(rows, 6, 1, 1 << 40)), min_count=1, every=1 << 40, cell_words=40)


def test_edges(spark, edge_frames, made_frame):
    assert group_variants(edge_frames["empty"]).collect() == []
    long = "ab" * 60_000
    rows = [(None, None), (1, ""), (2, "123 !!"), (None, "Worder worder"), (7, "worder " * 3), (7, "worder " * 3), (9, f"{long} {long}x " * 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["word"]: (r["n"], r["n_near"]) for r in group_variants(frame, every=1 << 40).collect()}
    assert found == {"worder": (8, 0), long: (5, 1), long + "x": (5, 1)}
    clash = made_frame.withColumn("word", F.lit("x")).withColumn("N", F.lit(1)).withColumn("run", F.lit(1)).withColumn("length", F.lit(1))
    assert sorted(group_variants(clash, 5, 2).collect()) == sorted(group_variants(made_frame, 5, 2).collect())


@given(st.lists(st.text(alphabet="abà×", min_size=1, max_size=6), min_size=1, max_size=30, unique=True))
@settings(max_examples=200, deadline=None)
def test_one_edit_and_counts(words):
    joined, first = spelling.letter_rows(words)
    counts = spelling.letter_counts(joined, first)
    pairs = [(i, j) for i in range(len(words)) for j in range(len(words)) if i != j and len(words[j]) - len(words[i]) in (0, 1)]
    left, right = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
    found = spelling.one_edit(joined, first, left, right)
    assert found.tolist() == [near(words[i], words[j]) for i, j in pairs]
    apart = np.abs(counts[left].astype(int) - counts[right]).sum(axis=1)
    assert (apart[found] <= 2).all()
    bits = spelling._parities(counts)
    assert (np.bitwise_count(bits[left] ^ bits[right]) <= apart).all()


@given(st.lists(st.lists(st.integers(0, 3), min_size=5, max_size=5), min_size=1, max_size=60), st.integers(1, 6),
       st.lists(st.integers(0, 3), min_size=5, max_size=5), st.integers(0, 2), st.integers(0, 2))
@settings(max_examples=300, deadline=None)
def test_a_search_leaves_out_no_point_in_reach(points, size, query, more, less):
    points, query = np.array(points, dtype=np.uint8), np.array([query], dtype=np.uint8)
    tree = KdTree.build(points, size)
    _, leaves = tree.search(query, more, less)
    diff = points.astype(int) - query
    reach = (np.maximum(diff, 0).sum(axis=1) <= more) & (np.maximum(-diff, 0).sum(axis=1) <= less)
    assert set(tree.leaf[reach].tolist()) <= set(leaves.tolist())
    assert len(set(leaves.tolist())) == len(leaves)
    for k in range(tree.leaves):
        assert (tree.leaf == k).sum() <= size or len(np.unique(points[tree.leaf == k], axis=0)) == 1
