from __future__ import annotations

import random

import brute
import numpy as np
import pyspark.sql.functions as F
import pytest

from millrace.llm import graph, similar_sets
from millrace.session import stage


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_sets.link_similar(frame).collect()}


@pytest.mark.parametrize("which", ["made_frame", "small"])
def test_components(which, request):
    frame = request.getfixturevalue(which)
    docs = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    assert found(frame) == brute.components(docs)


@pytest.fixture(scope="module")
def chains(spark):
    """Texts near the threshold at sizes about those of bands, and a passage that unlike texts share."""
    rng = random.Random(11)
    fresh = iter(f"w{i}" for i in range(10**6))
    docs = []
    for size in (1, 2, 3, 5, 8, 20, 62, 64, 66, 80, 127, 130, 160, 300):
        own = [next(fresh) for _ in range(size + 4)]
        docs.append(" ".join(own))
        for _ in range(6):  # each drifts from the one before it
            for _ in range(max(1, size // 40)):
                own = list(own)
                own[rng.randrange(len(own))] = next(fresh)
            own = own + [next(fresh) for _ in range(rng.randint(0, size // 9))]
            docs.append(" ".join(own))
        docs.append(" ".join(own[: int(len(own) * 0.82)]))
    passage = [next(fresh) for _ in range(70)]
    docs += [" ".join(passage + [next(fresh) for _ in range(rng.randint(8, 40))]) for _ in range(30)]
    rng.shuffle(docs)
    docs = list(enumerate(docs, start=100))
    return docs, stage(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), "chains")


@pytest.mark.parametrize("tile", [similar_sets.TILE, 4])
def test_no_link_is_lost_near_the_threshold(chains, tile, monkeypatch):
    monkeypatch.setattr(similar_sets, "TILE", tile)
    docs, frame = chains
    assert found(frame) == brute.components(docs)


def test_edges(edge_frames, made_frame):
    assert similar_sets.link_similar(edge_frames["empty"]).count() == 0
    rows = similar_sets.link_similar(edge_frames["no_ids"]).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"]) == [(1, 56, 1)]
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]
    rows = similar_sets.link_similar(edge_frames["equal"]).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (1, 1), (2, 1)]
    clash = made_frame.withColumn("component_id", F.lit("x")).withColumn("size", F.lit("x"))
    assert similar_sets.link_similar(clash).columns == ["doc_id", "n_shingles", "component_id"]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    words = [f"v{i}" for i in range(3000)]
    for size in (70, 130, 500):
        own = list(rng.choice(words, size))
        other = list(own)
        for _ in range(size // 30):
            other[rng.integers(size)] = "new"
        sets = similar_sets.Sets([" ".join(own).encode(), " ".join(other).encode()])
        one, two = (set(sets.hashes[sets.text == i].tolist()) for i in (0, 1))
        a, b = sets.sketches()
        if len(a) == len(b):
            assert len(a) * 8 >= size
            assert (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() <= len(one ^ two)


def test_folding_gives_the_smaller_sketch():
    sets = similar_sets.Sets([" ".join(f"u{i}" for i in range(150)).encode()])
    (sketch,) = sets.sketches()
    half = np.zeros(4 * len(sketch), dtype=np.uint8)
    bits = (4 * len(sketch)).bit_length() - 1
    np.add.at(half, (sets.hashes >> np.uint64(64 - bits)).astype(np.int64), 1)
    assert similar_sets._folded(sketch, len(sketch) // 2).tobytes() == np.packbits(half & 1).tobytes()


def test_graph_components(spark):
    edges = [(1, 2), (3, 2), (3, 4), (10, 11), (12, 11), (20, 20), *[(100 + i, 101 + i) for i in range(40)], *[(200, 201 + i) for i in range(30)]]
    rows = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {rows[i] for i in (1, 2, 3, 4)} == {1} and {rows[i] for i in (10, 11, 12)} == {10}
    assert {rows[i] for i in range(100, 141)} == {100} and {rows[i] for i in range(200, 231)} == {200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
