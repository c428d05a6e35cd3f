from __future__ import annotations

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing, tokenizing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, expected, width):
    own = {}
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist()
        assert ids == expected[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(expected[r["doc_id"]])
        own[r["doc_id"]] = own.get(r["doc_id"], 0) + r["length"]
    assert own == {i: len(x) for i, x in expected.items()}
    rows = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for r in rows:
        assert r["sequence_id"] * width + r["offset"] == at
        at += r["length"]
        assert r["offset"] + r["length"] <= width


@pytest.mark.parametrize("width", [4096, 7])
def test_pieces_hold_every_id_once(made_frame, made, width):
    expected = brute.pieces(made, Tokenizer.from_file(PATH))
    check(packing.pack(made_frame, PATH, width).collect(), expected, width)


def test_sequences_are_the_stream_cut(made_frame):
    pieces = packing.pack(made_frame, PATH, 64)
    rows = packing.assemble(pieces).orderBy("sequence_id").collect()
    assert [r["length"] for r in rows[:-1]] == [64] * (len(rows) - 1)
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)


def test_special_and_odd_texts_encode_as_the_tokenizer_does():
    texts = ["<|endoftext|> a<|ENDOFTEXT|>B", "don't can'T 's ''s", "É é Éx Å ΑΣ ΑΣ.", "a b　c", "",
             "x1y2 3.14,5 !!??", "words, words. (words) [words]-", "\U0001f600 ok", "a\x00b", "İstanbul"]
    plain = Tokenizer.from_file(PATH)
    encoder = tokenizing.WordEncoder(PATH)
    found = [x.tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert found == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_full_word_store_starts_anew(monkeypatch, made):
    monkeypatch.setattr(tokenizing, "WORDS_KEPT", 50)
    plain, encoder = Tokenizer.from_file(PATH), tokenizing.WordEncoder(PATH)
    for _, text in made:
        own = next(encoder.encode([(text or "").encode()])).tolist()
        assert own == plain.encode(text or "", add_special_tokens=False).ids


def test_edges(edge_frames):
    assert packing.pack(edge_frames["empty"], PATH).count() == 0
    lengths = [r["length"] for r in packing.pack(edge_frames["no_ids"], PATH).collect()]
    assert sorted(lengths)[0] == 1 and len(lengths) == 3
    assert packing.pack(edge_frames["equal"], PATH).count() == 3


def test_tokenizers_of_another_kind_are_refused(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from millrace.llm.tokenizing import WordEncoder

    letters = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyzTFA ,.!</w>\n\t")}
    own = Tokenizer(models.BPE(vocab=letters, merges=[]))
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = str(tmp_path / "plain.json")
    own.save(path)
    with pytest.raises(ValueError):
        WordEncoder(path)
    assert WordEncoder(public_tokenizers.path("word_bpe_49k.json")).special


def test_columns_that_clash_take_no_part(made_frame):
    import pyspark.sql.functions as F

    path = public_tokenizers.path("word_bpe_49k.json")
    clash = made_frame.withColumn("first", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("BLOCK", F.lit(2)).withColumn("length", F.lit(2))
    rows = lambda f: sorted((r["doc_id"], r["start"], r["length"], bytes(r["ids"])) for r in packing.pack(f, path).collect())
    assert rows(clash) == rows(made_frame)
