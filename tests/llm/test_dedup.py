from __future__ import annotations

import brute
import numpy as np
import pyspark.sql.functions as F
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import induced, line_dedup, marks, substring_dedup, suffix_dedup


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["made_frame", "small"])
def test_substrings(which, request):
    frame = request.getfixturevalue(which)
    rows = substring_dedup.dedup_substrings(frame).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], brute.sha(r["text"])) for r in rows} == brute.substring(pairs(frame))


@pytest.mark.parametrize("which", ["made_frame", "small"])
def test_bytes(which, request):
    frame = request.getfixturevalue(which)
    rows = suffix_dedup.dedup_bytes(frame).collect()
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], brute.sha(bytes(r["kept"]))) for r in rows}
    assert found == brute.byte_dedup(pairs(frame))


def test_bytes_with_a_queue_that_spills(made_frame):
    rows = suffix_dedup.dedup_bytes(made_frame, memory=100).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {i: x[1] for i, x in brute.byte_dedup(pairs(made_frame)).items()}


@pytest.mark.parametrize("which", ["made_frame", "small"])
def test_lines(which, request):
    frame = request.getfixturevalue(which)
    rows = line_dedup.dedup_lines(frame).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in rows} == brute.line_dedup(pairs(frame))


@pytest.mark.parametrize("dedup", [substring_dedup.dedup_substrings, suffix_dedup.dedup_bytes, line_dedup.dedup_lines])
def test_edges(dedup, edge_frames, made_frame):
    assert dedup(edge_frames["empty"]).count() == 0
    removed = "n_dropped" if dedup is line_dedup.dedup_lines else "n_removed"
    # rows without a doc_id neither lose anything nor make others lose
    assert [r[removed] for r in dedup(edge_frames["no_ids"]).collect()] == [0, 0, 0]
    by_doc = {r["doc_id"]: r[removed] for r in dedup(edge_frames["equal"]).collect()}
    assert by_doc[2] > 0 and by_doc[1] == 0
    # columns with the names of results are replaced, others kept
    clash = made_frame.withColumn("N_REMOVED", F.lit("x")).withColumn("n_words", F.lit("x")).withColumn("marks", F.lit(1)).withColumn("batch", F.lit("b"))
    found = dedup(clash)
    assert found.count() == made_frame.count() and "batch" in found.columns
    assert len({c.lower() for c in found.columns}) == len(found.columns)


@given(st.lists(st.binary(min_size=0, max_size=30).map(lambda b: bytes(x % 3 + 1 for x in b)), min_size=1, max_size=8), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_suffix_array_order_and_prefixes(parts, depth):
    text = np.frombuffer(b"".join(p * (1 + len(p) % 4) for p in parts) + b"\0", dtype=np.uint8)
    raw = text.tobytes()
    order = sorted(range(len(raw)), key=lambda i: raw[i:])
    places, prefixes = induced.suffix_array(text, depth, memory=20)
    assert places.tolist() == order
    for k in range(1, len(order)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        common = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
        assert prefixes[k] == min(common, depth)


def test_suffix_array_of_long_rising_runs():
    rng = np.random.default_rng(3)
    parts = [np.sort(rng.integers(1, 240, rng.integers(1, 40))) for _ in range(200)]
    text = np.concatenate([*parts, *parts[:50], [0]]).astype(np.uint8)
    raw = text.tobytes()
    assert induced.suffix_array(text, 50)[0].tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    function = line_dedup.PerfectHash.build(keys)
    assert sorted(function.slots(keys).tolist()) == list(range(len(keys)))
    assert len(line_dedup.PerfectHash.build(keys[:0]).slots(keys[:5])) == 5


def test_difference_cover_aligns_every_pair():
    period, cover = substring_dedup.PERIOD, substring_dedup.COVER
    assert all(any((a + d) % period in cover and (b + d) % period in cover for d in range(period)) for a in range(period) for b in range(period))


@pytest.mark.parametrize("later", [True, False])
@pytest.mark.parametrize("across", [True, False])
def test_settling_in_batches_marks_what_settling_at_once_does(later, across):
    rng = np.random.default_rng(2)
    docs = np.repeat(np.arange(40), 25)
    starts = np.tile(np.arange(25), 40)
    hashes = rng.integers(0, 90, len(docs)).astype(np.uint64)
    whole, _ = marks.settle(hashes, docs, starts, later, across)
    batch = docs // 7
    marked = np.zeros(len(docs), dtype=bool)
    kept = []
    for b in np.unique(batch):
        at = np.flatnonzero(batch == b)
        own, sent = marks.settle(hashes[at], docs[at], starts[at], later, across)
        marked[at[own]] = True
        kept.append(at[sent])
    kept = np.concatenate(kept)
    more, _ = marks.settle(hashes[kept], docs[kept], starts[kept], later, across)
    marked[kept[more]] = True
    assert np.array_equal(marked, whole)


def test_packed_numbers_come_back():
    for values in (np.array([], dtype="<i8"), np.array([-5, 0, 7, 1 << 40], dtype="<i8")):
        assert marks.unpack(marks.pack(values, True), "<i8", True).tolist() == values.tolist()
