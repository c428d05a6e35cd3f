from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import manifest
from millrace.llm.manifest import addresses, levels_of, prove_documents, widths
from millrace.session import stage

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def tree(leaves):
    """All levels, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def climb(levels, index, start):
    found = []
    for row in levels[:-1]:
        low = index // 16 * 16
        run = row[low : low + 16]
        found += run[: index - low] + run[index - low + 1 :]
        start = h(run[: index - low] + [start] + run[index - low + 1 :])
        index //= 16
    return found, start


def plain(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0], leaf(r[0], r[3], r[2], r[4], r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in groups[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for k, (doc_id, own, r) in enumerate(groups[s]):
            start = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                start = leaf(doc_id, s, r[2], r[4], None if r[1] is None else r[1].translate(brute.FOLD))
            lower, reached = climb(trees[s], k, start)
            upper, reached = climb(top, at, reached)
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], h(lower + upper), reached, reached == top[-1][0]))
    return out


def key(row):
    return tuple((v is not None, v) if not isinstance(v, bool) else (True, v) for v in row)


def check(frame, height=manifest.HEIGHT):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in frame.collect()]
    found = [tuple(r) for r in prove_documents(frame, height).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(found, key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("which", ["made_frame", "small", "nulls", "empty", "no_ids", "equal", "one"])
def test_proofs_equal_a_plain_tree(which, request, spark, edge_frames):
    if which == "nulls":
        rows = [(None, None, None, None, None), (1, None, "en", "a", 3), (5, "A Text", None, None, 6), (5, "A text", None, None, 6),
                (9, "ÀB\n", "fr", "é", None), (-4, "", "", "", 0), (7, "x" * 3_000_000 + "Y", "de", "a", 1)]
        frame = spark.createDataFrame(rows, KIND)
    elif which == "one":
        frame = spark.createDataFrame([(15, "One", "en", "a", 3)], KIND)
    else:
        frame = edge_frames[which] if which in edge_frames else request.getfixturevalue(which)
    check(frame)


def test_several_stages_and_a_hot_source(spark):
    """Blocks of 16 leaves, so that a source of 700 documents takes three stages."""
    rng = random.Random(2)
    rows = [(i, f"Text {i}", "en", "hot", 7) for i in range(700)] + [(1000 + i, "T", "fr", f"s{rng.randrange(40)}", 1) for i in range(300)]
    rows += [(2000 + i, "T", "fr", "s256", 1) for i in range(256)] + [(3000 + i, "T", "fr", "s16", 1) for i in range(16)]
    rng.shuffle(rows)
    frame = stage(spark.createDataFrame(rows, KIND).repartition(5), "several")
    check(frame, height=1)


def test_columns_that_clash_take_no_part(made_frame):
    clash = made_frame.withColumn("leaf", F.lit("x")).withColumn("grp", F.lit(1)).withColumn("digest", F.lit(2)).withColumn("ROOT", F.lit(2))
    assert sorted(prove_documents(clash).collect()) == sorted(prove_documents(made_frame).collect())


@given(st.integers(1, 4096), st.booleans())
@settings(max_examples=200, deadline=None)
def test_places_are_gapless_and_lower_trees_lie_together(leaves, tall):
    levels = levels_of(leaves, tall)
    count = widths(leaves, levels)
    assert count[0] == 1
    places = [addresses(d, np.arange(n), leaves, levels) for d, n in enumerate(count)]
    assert sorted(np.concatenate(places).tolist()) == list(range(sum(count)))
    assert places[0].tolist() == [0]
    if levels == 4 and leaves > 16:  # halves: the root and its children, then each grandchild with its children
        assert max(places[1].tolist()) < min(places[2].tolist())
        first = min(16, leaves)
        assert sorted([int(places[2][0]), *places[3][:first].tolist()]) == list(range(count[1] + 1, count[1] + 2 + first))
