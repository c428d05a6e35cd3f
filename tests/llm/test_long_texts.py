"""Very long texts and words are judged whole."""

from __future__ import annotations

import random
import time

import brute
import public_tokenizers
import pytest
import tokenizers

from millrace.llm import decontamination, language_id, line_dedup, packing, quality, similar_sets, spelling, substring_dedup, suffix_dedup, token_counts
from millrace.session import stage

WORD = "q" * 120_000


@pytest.fixture(scope="module")
def long_frame(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(5000)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    long = prose(60_000)
    rows = [(1, prose(80)), (2, long), (3, f"{prose(40)} {long[250_000:251_000]} {prose(30)}"), (4, f"x {WORD}"), (5, f"{prose(30)}\n{WORD}"),
            (6, "\n".join([prose(12)] * 9000)), (7, long + " end")]
    return rows, stage(spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string"), "long")


def test_substrings(long_frame):
    rows, frame = long_frame
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], brute.sha(r["text"])) for r in substring_dedup.dedup_substrings(frame).collect()}
    assert found == brute.substring(rows)


def test_bytes(long_frame):
    rows, frame = long_frame
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], brute.sha(bytes(r["kept"]))) for r in suffix_dedup.dedup_bytes(frame).collect()}
    assert found == brute.byte_dedup(rows)


def test_lines_sets_and_windows(long_frame, spark):
    rows, frame = long_frame
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(frame).collect()} == brute.line_dedup(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_sets.link_similar(frame).collect()} == brute.components(rows)
    items = [("a", " ".join(rows[1][1].split()[59_000:59_030])), ("b", WORD)]
    found = decontamination.find_contamination(frame, spark.createDataFrame(items, "item_id string, text string")).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in found} == brute.contamination(rows, items)


def test_statistics_languages_and_words(long_frame):
    rows, frame = long_frame
    texts = dict(rows)
    for r in quality.judge(frame).collect():
        own = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert own == brute.statistics(texts[r["doc_id"]])
    models = language_id.fit_dictionaries(frame)
    assert {r["lang_pred"] for r in language_id.identify(frame, models).collect()} == {"en"}
    found = spelling.count_words(frame.select("doc_id", "text"), 1000, 2, every=1 << 40).collect()
    assert [(r["word"], r["n"]) for r in found] == [(WORD, 2)]


def test_packing_of_long_documents(long_frame):
    rows, frame = long_frame
    path = public_tokenizers.path("word_bpe_49k.json")
    want = brute.pieces(rows, tokenizers.Tokenizer.from_file(path))
    total: dict = {}
    for r in packing.pack(frame, path).collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] == len(want[r["doc_id"]]) and r["offset"] + r["length"] <= 4096
    assert total == {i: len(x) for i, x in want.items()}


def test_long_words_are_counted_as_short_ones_are():
    rng = random.Random(1)
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -2.5, "▁a": -4.0, "bab": -4.5, "aba": -4.5, "é": -5.0, "▁abab": -9.5, "bbbbbb": -6.0}
    own = token_counts.Vocabulary(pieces)
    words = ["".join(rng.choices("abé日", (9, 9, 1, 1), k=n)) for n in (63, 64, 65, 200, 5000)] + ["ab" * 2500, "b" * 5000, "short", "a"]

    def count(word):
        text = token_counts.BLANK + word
        best = [(0.0, 0)]
        for i in range(1, len(text) + 1):
            found = [(best[j][0] - pieces[text[j:i]], best[j][1] + 1) for j in range(max(0, i - 6), i) if text[j:i] in pieces]
            if text[i - 1] not in pieces:
                found.append((best[i - 1][0] - own.unknown, best[i - 1][1] + len(text[i - 1].encode())))
            best.append(min(found))
        return best[-1][1]

    assert token_counts.count_tokens(words, own).tolist() == [count(w) for w in words]
    short = [w[:60] for w in words]
    assert [token_counts.count_alone(w, own) for w in short] == token_counts.count_tokens(short, own).tolist()


def test_a_word_of_a_megabyte_takes_seconds():
    own = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    words = [f"w{i}" for i in range(20_000)]
    start = time.process_time()
    counts = token_counts.count_tokens([*words, "aGVsbG8gd29ybGQ" * 70_000], own)
    assert time.process_time() - start < 30 and counts[-1] > 70_000
