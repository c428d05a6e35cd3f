from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from millrace.llm import suffix_dedup
from millrace.session import stage


@pytest.mark.parametrize("which", ["made_frame", "phrases"])
def test_stretches_of_a_hot_minimizer_are_dealt_over_shards(which, spark, request, monkeypatch):
    largest = []
    if which == "made_frame":
        frame = request.getfixturevalue(which)
    else:
        rng = random.Random(4)
        prose = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
        phrase, passage = prose(16), prose(70)
        # a phrase in differing contexts, and some of these contexts again
        texts = [prose(90) + phrase + prose(90) for _ in range(300)]
        texts += [prose(20) + texts[k][60:150] + prose(9) for k in range(0, 300, 10)] + [passage + prose(20) + passage for _ in range(9)]
        frame = stage(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), "phrases")
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]

    def sizes():
        hot = suffix_dedup.hot_minimizers(frame.select("doc_id", "text"), 50)
        marks = suffix_dedup.mark(frame.select("doc_id", "text"), suffix_dedup.minimizer_places(50), later=False, across=True, wide=False, size=0)
        pieces = suffix_dedup._pieces(frame.join(marks, "doc_id").select("doc_id", "text", "marks"), 50, 64, hot)
        by_shard: dict = {}
        for r in pieces.filter("sent").collect():
            lanes = np.frombuffer(r["keys"], dtype="<u4")
            for lane, size in zip(lanes.tolist(), suffix_dedup.unpack(r["sizes"], "<u4").tolist(), strict=True):
                by_shard[lane] = by_shard.get(lane, 0) + size
        return len(hot), max(by_shard.values())

    plain, held = sizes()
    monkeypatch.setattr(suffix_dedup, "HOT_SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 2000)
    many, after = sizes()
    largest.append((held, after))
    print(which, plain, many, largest)
    if which == "phrases":
        assert plain == 0 and many > 0 and after < held / 4
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], brute.sha(bytes(r["kept"]))) for r in suffix_dedup.dedup_bytes(frame).collect()}
    assert found == brute.byte_dedup(rows)


def pieces(rng):
    """Pieces with their minimizers' places, as a shard gets them: windows of a few passages."""
    passages = [bytes(rng.choices(b"abcde ", k=120)) for _ in range(12)]
    out = []
    for k in range(400):
        own = rng.choice(passages)
        at = rng.randrange(0, 40)
        size = rng.randrange(50, 80)
        out.append((own[at : at + size] if k % 3 else bytes(rng.choices(b"abcde ", k=size)), rng.randrange(40)))
    out.sort(key=lambda x: x[1])
    return out


@pytest.mark.parametrize("memory", [16, 100, 2500])
def test_a_shard_of_ten_times_the_memory(memory, monkeypatch):
    rng = random.Random(7)
    rows = pieces(rng)
    raw, sizes, docs = b"".join(r[0] for r in rows), np.array([len(r[0]) for r in rows]), np.array([r[1] for r in rows])
    assert len(raw) > 10 * memory
    mapped = []
    plain = suffix_dedup.Scratch.array

    def array(self, size, kind):
        out = plain(self, size, kind)
        mapped.append(isinstance(out, np.memmap))
        return out

    monkeypatch.setattr(suffix_dedup.Scratch, "array", array)
    found = [x.tolist() for x in suffix_dedup.repeated_windows(raw, sizes, docs, 50, memory)]
    assert any(mapped)
    mapped.clear()
    assert found == [x.tolist() for x in suffix_dedup.repeated_windows(raw, sizes, docs, 50)]
    assert not any(mapped)
    hit = {(p, o + k) for p, o, s in zip(*found, strict=True) for k in range(s - 49)}
    first: dict = {}
    for text, doc in rows:
        for k in range(len(text) - 49):
            first[text[k : k + 50]] = min(first.get(text[k : k + 50], 99), doc)
    assert hit == {(i, k) for i, (text, doc) in enumerate(rows) for k in range(len(text) - 49) if first[text[k : k + 50]] < doc}


def test_reaches_hold_every_window_that_different_pieces_share():
    """Any minimizers' places do, as long as equal windows have them at equal places."""
    rng = random.Random(3)
    core = bytes(rng.choices(b"abcdefgh", k=16))
    rows = []
    for k in range(300):
        left = bytes(rng.choices(b"ab", k=34))[rng.randrange(0, 34):]
        right = bytes(rng.choices(b"ab", k=34))[: rng.randrange(0, 35)]
        if k % 2:  # agree with an earlier one on some bytes of each side
            old = rng.choice(rows) if rows else (left + core + right, len(left), 0)
            left = (left + old[0][: old[1]])[-34:] if rng.random() < 0.7 else left
            right = (old[0][old[1] + 16 :] + right)[:34] if rng.random() < 0.7 else right
        if len(left) + len(right) >= 34:
            rows.append((left + core + right, len(left), rng.randrange(9)))
    rows = sorted({r[0]: r for r in rows}.values(), key=lambda r: r[2])
    sizes, at, docs = (np.array(x) for x in ([len(r[0]) for r in rows], [r[1] for r in rows], [r[2] for r in rows]))
    begin = np.cumsum(sizes) - sizes
    start, end = suffix_dedup.shared_reaches(b"".join(r[0] for r in rows), begin, sizes, at, docs, 50)
    windows: dict = {}
    for i, (text, place, doc) in enumerate(rows):
        for k in range(len(text) - 49):
            if k <= place <= k + 34:
                windows.setdefault((text[k : k + 50], place - k), []).append((i, k, doc))
    met = 0
    for its in windows.values():
        if len({d for _, _, d in its}) > 1:
            for i, k, _ in its:
                met += 1
                assert start[i] <= k and k + 50 <= end[i]
    assert met > 50 and (end == 0).any()
