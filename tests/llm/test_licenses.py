from __future__ import annotations

import random

import brute
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import licenses
from millrace.llm.licenses import NOTICES, PHRASES, block_words, needed, scan_licenses, words_of
from millrace.session import stage


def judged(text, notices=NOTICES, threshold=0.9):
    words = brute.ITEM.findall((text or "").translate(brute.FOLD))
    base = sorted(
        (label, k, len(p.split())) for label, p in PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
    met = []
    for label, notice in notices:
        size = 2
        while size < 2 * len(notice.split()):
            size *= 2
        own, first = set(notice.split()), 0
        while first == 0 or first + size // 2 < len(words):
            share = len(own & set(words[first : first + size])) / len(own)
            if share >= threshold - 1e-9:
                met.append((label, first, size, share))
            first += size // 2
    labels = sorted({x[0] for x in base})
    return len(words), base, sorted(met), labels, sorted({*labels, *[x[0] for x in met]}), 1.0 if base else max([x[3] for x in met], default=0.0)


def told(r):
    return (r["n_words"], sorted(map(tuple, r["base"])), [tuple(x) for x in r["met"]], list(r["base_labels"]), list(r["labels"]), r["score"])


def check(frame, **options):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    found = [(r["doc_id"], told(r)) for r in scan_licenses(frame, **options).collect()]
    want = [(i, judged(t, **options)) for i, t in rows]
    assert sorted(found, key=str) == sorted(want, key=str)
    return want


def made_rows():
    rng = random.Random(6)
    vocabulary = sorted({w for _, t in NOTICES for w in t.split()} | {"ä", "the", "x1", "of"})
    rows = [None, "", "CC BY", "cc\nby cc-by", "All rights reserved. all RIGHTS reserved", "all rights", "x" * 100_000 + " cc by"]
    for label, notice in NOTICES:
        words = notice.split()
        rows.append(notice.title().replace(" ", "\n", 2))
        rng.shuffle(words)
        rows.append(" - ".join(words[1:]) + f" {label}")
        rows.append(" ".join(rng.choices(vocabulary, k=200)) + ". " + notice + " " + " ".join(rng.choices(vocabulary, k=70)))
    rows += [" ".join(rng.choices(vocabulary, k=rng.randrange(120))) for _ in range(60)]
    rows.append(" ".join(rng.choices(vocabulary, k=50_000)) + " released under the MIT license")
    return list(enumerate(rows))


@pytest.mark.parametrize("which", ["made_frame", "small", "notices"])
def test_scan_equals_counting_in_every_block(which, request, spark):
    if which == "notices":
        frame = stage(spark.createDataFrame(made_rows(), "doc_id long, text string").repartition(3), "licenses-test")
    else:
        frame = request.getfixturevalue(which)
    want = check(frame)
    assert which == "made_frame" or {"mit", "apache-2.0"} <= {x for _, w in want for x in w[4]}


@pytest.mark.parametrize("threshold", [0.3, 0.6, 1.0])
def test_thresholds(threshold, spark):
    frame = stage(spark.createDataFrame([r for r in made_rows() if len(r[1] or "") < 5000], "doc_id long, text string"), "licenses-test")
    check(frame, threshold=threshold)


def test_edges(edge_frames, made_frame):
    assert scan_licenses(edge_frames["empty"]).collect() == []
    for name in ("no_ids", "equal"):
        check(edge_frames[name].select("doc_id", "text"))
    clash = made_frame.withColumn("SCORE", F.lit("x")).withColumn("met", F.lit(1)).withColumn("_row", F.lit(1)).withColumn("ranks", F.lit(7))
    found = scan_licenses(clash)
    assert found.count() == made_frame.count() and "ranks" in found.columns
    assert len({c.lower() for c in found.columns}) == len(found.columns)


def test_notices_that_cannot_be_scanned_are_refused(made_frame, monkeypatch):
    with pytest.raises(ValueError):
        scan_licenses(made_frame, notices=[("none", "--")])
    monkeypatch.setattr(licenses, "MAX_WORDS", 5)
    with pytest.raises(ValueError):
        scan_licenses(made_frame)


@given(st.integers(1, 60), st.integers(0, 200), st.floats(0.01, 1))
def test_blocks_hold_every_run_and_needs_are_ceilings(n, start, threshold):
    width = block_words(n)
    assert width >= 2 * n and width & (width - 1) == 0
    block = start // (width // 2) * (width // 2)
    assert block <= start and start + n <= block + width
    assert needed(n, threshold) - 1 < n * threshold + 1e-5 <= needed(n, threshold) + 2e-5


@given(st.text())
@settings(max_examples=300)
def test_words(text):
    assert [w.decode() for w in words_of(text.encode())] == brute.ITEM.findall(text.translate(brute.FOLD))
