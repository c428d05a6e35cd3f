from __future__ import annotations

import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import language_id


def sizes(text, dictionaries):
    raw = re.sub(r"[\W\d_]+", " ", text.lower()).encode()
    out = []
    for lang, own in dictionaries:
        data = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total = 0
        for k in range(0, len(raw), language_id.BLOCK_BYTES):
            packer = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=data, write_content_size=False)
            total += len(packer.compress(raw[k : k + language_id.BLOCK_BYTES]))
        out.append((total, lang))
    return sorted(out)


def by_hand(text, dictionaries):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0, False
    found = sizes(text, dictionaries)
    margin = 1 - found[0][0] / found[1][0]
    return found[0][1], margin, margin >= language_id.MIN_MARGIN


def sample_by_hand(rows, hashes):
    """Per language the texts whose doc_id hashes lowest, cut as the bounds say."""
    out = {}
    for lang in sorted({r[2] for r in rows if r[2] and r[1] and r[0] is not None}):
        own = sorted((hashes[i], i, t) for i, t, x in rows if x == lang and t and i is not None)[: language_id.TEXTS_PER_LANGUAGE]
        parts = [re.sub(r"[\W\d_]+", " ", t[: language_id.BYTES_PER_TEXT].lower()).encode()[: language_id.BYTES_PER_TEXT] for _, _, t in own]
        out[lang] = b"\n".join(parts)[: language_id.DICTIONARY_BYTES]
    return list(out.items())


def test_choice_margin_and_ties_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    hashes = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    models = language_id.fit_dictionaries(docs)
    assert models == sample_by_hand(rows, hashes)
    # a language with another's dictionary gives ties, which go to the first name
    twice = sorted([*models, ("aa", dict(models)["en"])])
    for own in (models, twice):
        found = {r["doc_id"]: (r["lang_pred"], r["score"], r["accepted"]) for r in language_id.identify(docs, own).collect()}
        for i, text, _ in rows:
            lang, margin, accepted = by_hand(text, own)
            assert found[i][0] == lang and found[i][1] == pytest.approx(margin, abs=1e-12) and found[i][2] == accepted
    assert {x[0] for x in found.values()} & {"aa"} and "en" not in {x[0] for x in found.values()}


@pytest.mark.parametrize("spare", [0.01, 1, 4, 1000])
def test_the_sample_is_the_lowest_however_many_rows_are_ranked(spark, spare, monkeypatch):
    """Also where the cut leaves too few, and where rows repeat."""
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abc ", k=30)), rng.choice(["x", "y"])) for i in range(400)] + [(1, "abc", "z")] * 60
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "TEXTS_PER_LANGUAGE", 9)
    monkeypatch.setattr(language_id, "SPARE", spare)
    hashes = {r["doc_id"]: r["h"] for r in frame.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    assert language_id.fit_dictionaries(frame) == sample_by_hand(sorted(set(rows)), hashes)


@pytest.mark.parametrize("text", ["½ ²", "①", "Ⅷ", "12 _ !!", "", None])
def test_texts_without_a_letter_are_undetermined(text):
    assert language_id._choose(text, [("de", zstandard.ZstdCompressor())]) == ("und", 0.0, False)


def test_letters_of_any_script_count():
    assert all(language_id.has_letter(x) for x in ("a", "é", "日", "½ ª", "१क"))
