from __future__ import annotations

import gzip
import io

import brute
import numpy as np
import public_tokenizers
import pyspark.sql.functions as F
import pytest

from millrace.llm import decontamination, language_id, quality, token_counts, warc
from millrace.llm.frames import read_table

SMALL = "/root/testdata/sf0.001"


# benchmark windows


@pytest.fixture(scope="module")
def items(spark, made):
    texts = dict(made)
    long = next(t for t in texts.values() if t and len(t.split()) > 100 and t.isascii() is False)
    words = long.split()
    rows = [(1, " ".join(words[5:40])), (2, " ".join(words[10:16])), (3, None), (4, " . "), (5, " ".join(words[5:40])), (None, words[0]), (6, "一 " + " ".join(words[50:70]).upper())]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("bound", [decontamination.AUTOMATON_BYTES, 200])
def test_windows_are_found_with_one_automaton_or_several(made, made_frame, items, bound, monkeypatch):
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", bound)
    rows, frame = items
    expected = brute.contamination(made, [r for r in rows if r[0] is not None])
    found = decontamination.find_contamination(made_frame, frame).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in found} == expected
    assert any(x[1] > 0 for x in expected.values())
    texts = dict(made)
    for r in found:
        spans = [(s["start"], s["end"]) for s in r["hit_spans"]]
        inside = sum(len(brute.ITEM.findall(texts[r["doc_id"]][a:b])) for a, b in spans)
        assert inside == r["n_hit"] or bound == 200  # parts' spans may overlap


def test_benchmark_edges(spark, edge_frames, items):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_contamination(edge_frames["empty"], items[1]).count() == 0
    rows = decontamination.find_contamination(edge_frames["no_ids"].withColumn("n_hit", F.lit("x")), empty).collect()
    assert [r["n_hit"] for r in rows] == [0, 0, 0] and sorted(r["n_words"] for r in rows) == [0, 60, 60]
    same = spark.createDataFrame([(9, " ".join(f"word{i}" for i in range(20, 30)))], "item_id long, text string")
    assert [r["n_hit"] for r in decontamination.find_contamination(edge_frames["equal"], same).collect()] == [10, 10, 10]


# languages


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = language_id.fit_dictionaries(docs.filter(~language_id.held_out()))
    assert [m[0] for m in models] == ["de", "en", "es", "fr"]
    assert all(len(m[1]) <= language_id.DICTIONARY_BYTES for m in models)
    rows = language_id.identify(docs.filter(language_id.held_out()), models).collect()
    right = np.mean([r["lang"] == r["lang_pred"] for r in rows])
    kept = [r for r in rows if r["accepted"]]
    assert right > 0.96 and np.mean([r["lang"] == r["lang_pred"] for r in kept]) >= right
    assert len(kept) > 0.97 * len(rows)


def test_language_edges(spark, edge_frames):
    text = "the quick brown fox jumps over the lazy dog and runs away from it "
    models = language_id.fit_dictionaries(spark.createDataFrame(
        [(1, text * 3, "en"), (2, "le renard brun saute sur le chien et part loin de lui " * 3, "fr"), (3, None, "fr"), (4, text, None), (None, text, "xx")],
        "doc_id long, text string, lang string"))
    assert [m[0] for m in models] == ["en", "fr"]
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !!"), (4, "the lazy dog and the quick fox"), (4, "the lazy dog and the quick fox"), (5, "日")], "doc_id long, text string")
    found = [(r["lang_pred"], r["accepted"]) for r in language_id.identify(rows, models).orderBy("doc_id").collect()]
    assert found[:5] == [("und", False)] * 3 + [("en", True)] * 2 and found[5][0] in ("en", "fr")
    assert all(0 <= r["score"] <= 1 for r in language_id.identify(rows, models).collect())
    assert {r["lang_pred"] for r in language_id.identify(rows, []).collect()} == {"und"}
    assert language_id.fit_dictionaries(edge_frames["empty"]) == []
    assert language_id.identify(edge_frames["empty"].withColumn("score", F.lit("x")), models).count() == 0


# quality


@pytest.mark.parametrize("which", ["made_frame", "small"])
def test_statistics(which, request):
    frame = request.getfixturevalue(which)
    texts = {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}
    for r in quality.judge(frame).collect():
        own = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert own == brute.statistics(texts[r["doc_id"]])


def test_verdict_follows_concentration_in_numpy(spark, monkeypatch):
    monkeypatch.setattr(quality, "MIN_GROUP", 20)
    rows = {r["doc_id"]: r for r in quality.judge(read_table(spark, "/root/testdata/sf0.01", "documents")).collect()}
    kinds = {r["doc_id"]: (r["lang"], r["source"]) for r in read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang", "source").collect()}
    groups = {}
    for i, r in rows.items():
        if not r["base_failed"]:
            groups.setdefault(kinds[i], []).append(i)
    floors = np.array(list(quality.FLOORS.values())) * quality.SCALE

    def half_up(x):
        return np.sign(x) * np.floor(np.abs(x) + 0.5)

    def features(r):
        share = lambda c, of: np.log1p(100 * r[c] / r[of])
        values = [np.log(r["word_chars"] / r["n_words"]), np.log(r["n_words"]), share("n_symbols", "word_chars"), np.log1p(r["n_dup_lines"]), share("n_repeat_words", "n_words")]
        return half_up(np.array(values) * quality.SCALE)

    compared = 0
    for ids in groups.values():
        if len(ids) < quality.MIN_GROUP:
            assert all(rows[i]["distance"] is not None for i in ids)  # judged by the language or all rows
            continue
        x = np.array([features(rows[i]) for i in ids])
        middle = np.median(x, axis=0)
        spread = np.median(np.abs(x - middle), axis=0)
        d = (((x - middle) / (1.4826 * spread + floors)) ** 2).sum(axis=1)
        for _ in range(quality.STEPS):
            bucket = half_up(quality.SCALE * np.log(d + 1e-3))
            near = x[bucket <= np.ceil(np.percentile(bucket, 100 * quality.SUBSET))]
            cov = quality.consistency() * np.cov(near.T, bias=True) + np.diag(floors**2)
            y = x - near.mean(axis=0)
            d = np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y)
        for i, value in zip(ids, d, strict=True):
            assert rows[i]["distance"] == pytest.approx(value, rel=1e-6, abs=1e-9)
            assert rows[i]["kept"] == (rows[i]["distance"] <= quality.CUTOFF)
            compared += 1
    assert compared > 0


def test_clean_documents_stay_and_symbol_junk_goes(spark):
    docs = read_table(spark, "/root/testdata/sf0.1", "documents")
    labels = read_table(spark, "/root/testdata/sf0.1", "labels")
    rows = quality.judge(docs).join(labels.select("doc_id", "quality"), "doc_id").filter("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()
    share = {r["quality"]: r["share"] for r in rows}
    assert share[1] > 0.99 and share[0] < 0.3


def test_quality_edges(edge_frames, made_frame):
    assert quality.judge(edge_frames["empty"]).count() == 0
    rows = quality.judge(edge_frames["no_ids"]).collect()
    assert sorted((r["n_words"], r["kept"]) for r in rows) == [(0, False), (60, True), (60, True)]
    assert [r["kept"] for r in quality.judge(edge_frames["equal"]).collect()] == [True] * 3
    assert quality.judge(made_frame.withColumn("kept", F.lit("x"))).count() == made_frame.count()


def test_chi_square_points():
    assert quality.chi_square_point(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality.chi_square_point(0.5, 7) == pytest.approx(6.3458, abs=1e-3)


# token counts


def brute_count(word, pieces, unknown):
    text = token_counts.BLANK + word
    best = [(0.0, 0)]
    for i in range(1, len(text) + 1):
        found = [(best[j][0] - pieces[text[j:i]], best[j][1] + 1) for j in range(i) if text[j:i] in pieces]
        if text[i - 1] not in pieces:
            found.append((best[i - 1][0] - unknown, best[i - 1][1] + len(text[i - 1].encode())))
        best.append(min(found))
    return best[-1][1]


def test_counts_of_a_small_vocabulary():
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -2.5, "▁a": -4.0, "bab": -4.5, "aba": -4.5, "é": -5.0, "▁abab": -9.5}
    own = token_counts.Vocabulary(pieces)
    words = ["", "a", "ab", "aba", "abab", "ababab", "bab", "é", "éa", "x", "xab", "日本", "\U0001f600", "a" * 40]
    assert token_counts.count_tokens(words, own).tolist() == [brute_count(w, pieces, own.unknown) for w in words]
    assert token_counts.count_tokens([], own).tolist() == []


def test_counts_of_documents(made_frame, made, edge_frames):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = token_counts.sentencepiece_scores(path)
    unknown = min(pieces.values()) - token_counts.UNKNOWN_BELOW
    cut = {w: brute_count(w, pieces, unknown) for _, t in made for w in brute.words(t) if len(w) < 60}
    found = {r["doc_id"]: r for r in token_counts.add_token_counts(made_frame, path).collect()}
    for i, text in made:
        own = brute.words(text)
        assert found[i]["n_words"] == len(own)
        if all(w in cut for w in own):
            assert found[i]["n_tokens"] == sum(cut[w] for w in own)
    assert token_counts.add_token_counts(edge_frames["empty"], path).count() == 0
    assert len({r["n_tokens"] for r in token_counts.add_token_counts(edge_frames["equal"].withColumn("n_tokens", F.lit("x")), path).collect()}) == 1


# archives


def test_archives_round_trip(spark):
    html = ["<p>same</p>", None, "", "<p>é\r\n\r\nWARC/1.0</p>", "<p>same</p>", "x" * 100_000, "<p>same</p>", "", "Content-Length: 5\r\n\r\n"]
    rows = [(i, None if i == 2 else f"http://a/{i} b", h) for i, h in enumerate(html)] + [(4, "http://a/4 b", "<p>same</p>"), (None, "u", "<p>same</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = warc.archive_pages(pages)
    found = warc.read_archives(archives).collect()
    assert len(found) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", 99), i)
    for r in found:
        payload = (dict((i, h) for i, _, h in rows[:9]).get(r["page_id"], "<p>same</p>") or "").encode()
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == warc.digest(payload)
        own = first[payload.decode()]
        if r["page_id"] in (None, own):
            assert (r["record_type"], r["refers_to"]) == ("response", None) and bytes(r["payload"]) == payload
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", own, None)
    for r in archives.collect():  # every record is a member of its own, and the index says where
        raw = open(r["archive"].removeprefix("file:"), "rb").read()
        lines = [x.split() for x in open(r["index"].removeprefix("file:"))]
        parts = [gzip.decompress(raw[int(a) : int(a) + int(n)]) for a, n, *_ in lines]
        assert b"".join(parts) == gzip.decompress(raw) and all(p.startswith(b"WARC/1.0\r\n") for p in parts)


def test_archive_edges(spark):
    kind = "page_id long, url string, html string"
    assert warc.read_archives(warc.archive_pages(spark.createDataFrame([], kind))).count() == 0
    rows = warc.read_archives(warc.archive_pages(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], kind), min_bytes=3)).collect()
    assert {r["page_id"]: r["refers_to"] for r in rows} == {1: None, 2: None, 3: None, 4: 3}


def test_streams_of_several_members_and_cut_ones():
    records = [warc.record(i, "u", b"x" * i, warc.digest(b"x" * i)) for i in range(5)]
    raw = gzip.compress(b"".join(records[:2])) + gzip.compress(b"".join(records[2:]))
    assert list(warc.split_records(warc.inflated(io.BytesIO(raw)))) == records
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"".join(records)[:-3]])))
