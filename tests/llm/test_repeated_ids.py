"""Rows that share a doc_id, with equal and with different contents."""

from __future__ import annotations

import hashlib

import brute
import pytest

from millrace.llm import decontamination, language_id, line_dedup, packing, quality, similar_sets, substring_dedup, suffix_dedup, token_counts, warc
from millrace.llm.frames import read_table


def contents(frame):
    found: dict = {}
    for r in frame.collect():
        found.setdefault(r["doc_id"], set())
        if r["text"] is not None:
            found[r["doc_id"]].add(r["text"])
    return found


def test_bytes_of_rows_that_share_an_id(edge_frames):
    frame = edge_frames["several"]
    docs = contents(frame)
    want = {}
    for i in docs:
        earlier = {t[k : k + 50] for j in docs if j < i for t in docs[j] for k in range(len(t) - 49)}
        for t in docs[i]:
            gone = [False] * len(t)
            for k in range(len(t) - 49):
                if t[k : k + 50] in earlier:
                    gone[k : k + 50] = [True] * 50
            want[i, t] = "".join(c for c, g in zip(t, gone, strict=True) if not g)
    rows = suffix_dedup.dedup_bytes(frame).collect()
    assert len(rows) == frame.count()
    for r in rows:
        kept = want.get((r["doc_id"], r["text"]), "")
        assert (r["n_bytes"], r["n_removed"], bytes(r["kept"]).decode()) == (len(r["text"] or ""), len(r["text"] or "") - len(kept), kept)
    # a copy goes, the other text of its doc_id stays but for what an earlier document has of it
    kept = {(r["doc_id"], r["text"]): r["n_removed"] for r in rows}
    a, b = sorted(t for t in docs[9] if t and t not in docs[1]) + sorted(docs[1]), None
    assert kept[9, a[-1]] == len(a[-1]) and 0 < kept[9, a[0]] < len(a[0])


def test_words_of_rows_that_share_an_id(edge_frames):
    frame = edge_frames["several"]
    docs, seen, want = contents(frame), set(), {}
    for i in sorted(docs):
        for t in sorted(docs[i], key=str.encode):
            own = brute.words(t)
            gone = [False] * len(own)
            for k in range(len(own) - 19):
                window = tuple(own[k : k + 20])
                if window in seen:
                    gone[k : k + 20] = [True] * 20
                seen.add(window)
            want[i, t] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g))
    rows = substring_dedup.dedup_substrings(frame.withColumn("whole", frame["text"])).collect()
    assert len(rows) == frame.count()
    for r in rows:
        assert (r["n_words"], r["n_removed"], r["text"]) == want.get((r["doc_id"], r["whole"]), (0, 0, ""))


def test_similar_documents_that_share_an_id(edge_frames):
    frame = edge_frames["several"]
    docs = [(i, min(t, key=str.encode) if t else None) for i, t in contents(frame).items()]
    rows = similar_sets.link_similar(frame).collect()
    assert len(rows) == frame.count()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.components(docs)


def test_pages_that_share_an_id(spark):
    """The payload of a page's other row is neither dropped nor taken for a copy."""
    rows = [(1, "u", "<p>same</p>"), (5, "u", "<p>same</p>"), (5, "u", "<p>own</p>"), (5, "v", "<p>own</p>"), (7, "u", "<p>own</p>"), (7, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = warc.read_archives(warc.archive_pages(pages)).collect()
    assert sorted((r["page_id"], bytes(r["payload"] or b"-"), r["record_type"], r["refers_to"] or 0) for r in found) == [
        (1, b"<p>same</p>", "response", 0), (5, b"-", "revisit", 1), (5, b"<p>own</p>", "response", 0), (5, b"<p>own</p>", "response", 0),
        (7, b"-", "response", 0), (7, b"-", "revisit", 5)]
    whole = {hashlib.sha1((h or "").encode()).digest() for _, _, h in rows}
    assert {hashlib.sha1(bytes(r["payload"])).digest() for r in found if r["record_type"] == "response"} == whole


def test_a_payload_that_does_not_match_its_digest_is_refused(spark, tmp_path):
    import gzip

    raw = warc.record(1, "u", b"whole", warc.digest(b"other"))
    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(raw))
    archives = spark.createDataFrame([(str(path), None)], "archive string, revisits array<struct<page_id:long,payload_digest:string,refers_to:long>>")
    with pytest.raises(Exception, match="match"):
        warc.normalise(archives, str(tmp_path / "out")).collect()


def test_clashing_columns_of_pages(spark):
    import pyspark.sql.functions as F

    pages = read_table(spark, "/root/testdata/sf0.001", "pages").limit(20)
    clash = pages.withColumn("archive", F.lit("x")).withColumn("payload", F.lit(1)).withColumn("REFERS_TO", F.lit(1))
    keys = lambda frame: sorted((r["page_id"], r["payload_digest"], r["record_type"]) for r in warc.read_archives(warc.archive_pages(frame)).collect())
    assert keys(clash) == keys(pages)


@pytest.mark.parametrize("which", ["lines", "packing", "quality", "language", "tokens", "benchmark"])
def test_other_operators_judge_each_row(which, edge_frames, spark):
    """One result a row, equal for equal rows."""
    import public_tokenizers

    frame = edge_frames["several"]
    if which == "lines":
        rows = [(r["doc_id"], r["n_lines"]) for r in line_dedup.dedup_lines(frame).collect()]
    elif which == "packing":
        pieces = packing.pack(frame, public_tokenizers.path("word_bpe_49k.json")).collect()
        rows = [(r["doc_id"], 0) for r in pieces if r["start"] == 0]
    elif which == "quality":
        rows = [(r["doc_id"], r["kept"]) for r in quality.judge(frame).collect()]
    elif which == "language":
        rows = [(r["doc_id"], r["lang_pred"]) for r in language_id.identify(frame, [("en", b"some words of a language")]).collect()]
    elif which == "tokens":
        rows = [(r["doc_id"], r["n_tokens"]) for r in token_counts.add_token_counts(frame, public_tokenizers.path("piece_bpe_32k.model")).collect()]
    else:
        items = spark.createDataFrame([("a", "none of these words")], "item_id string, text string")
        rows = [(r["doc_id"], r["n_hit"]) for r in decontamination.find_contamination(frame, items).collect()]
    assert sorted(i for i, _ in rows) == sorted(r["doc_id"] for r in frame.collect())
