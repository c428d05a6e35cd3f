from __future__ import annotations

import os

import brute
import corpus_pipeline
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F
from test_language_by_hand import by_hand

from millrace.llm import language_id
from millrace.session import stage

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def similar(docs):
    """The smallest doc_id of each group."""
    groups = brute.components(docs)
    return [(i, t) for i, t in docs if groups[i][1] == i]


def lines(docs):
    kept = [(i, x[2]) for i, x in brute.line_dedup(docs).items()]
    return [(i, t) for i, t in kept if brute.words(t)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    def make(rows, items=()):
        path = str(tmp_path_factory.mktemp("tables"))
        spark.createDataFrame(rows, KIND).write.parquet(os.path.join(path, "documents.parquet"))
        spark.createDataFrame(list(items), "item_id long, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
        return path

    return make


def test_stages_equal_plain_ones(spark, folder):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    # and a near copy, which the third stage drops
    copy = given.filter("n_chars between 600 and 3000").orderBy("doc_id").limit(1).withColumns(
        {"doc_id": F.lit(900_000).cast("long"), "text": F.concat("text", F.lit("\nyet another line"))})
    path = folder([tuple(r) for r in given.unionByName(copy).select("doc_id", "text", "lang", "source", "n_chars").collect()],
                  [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    models = language_id.fit_dictionaries(docs.filter(~language_id.held_out()))
    own = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    steps = [
        lambda rows: [(i, t) for i, t in rows if by_hand(t, models)[2]], lines, similar,
        lambda rows: [(i, t) for i, t in rows if brute.contamination([(i, t)], items)[i][1] == 0],
    ]
    frame = docs
    for (name, function), step in zip(corpus_pipeline.STAGES[:-1], steps, strict=True):
        frame = stage(function(spark, frame, path), name)
        assert frame.columns == docs.columns
        before, own = own, step(own)
        assert sorted((r["doc_id"], r["text"]) for r in frame.collect()) == sorted(own), name
        assert len(own) <= len(before), name
    assert len(own) < docs.count()
    want = brute.pieces(own, tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    pieces = corpus_pipeline.run(spark, path).collect()
    seen: dict = {}
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == seen.get(r["doc_id"], 0)
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert brute.crc(ids) == r["ids_crc32"] and r["doc_tokens"] == len(want[r["doc_id"]])
        seen[r["doc_id"]] = r["start"] + r["length"]
    assert seen == {i: len(x) for i, x in want.items()}


def test_every_stage_takes_nulls_repeats_and_empty_tables(spark, folder):
    english = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").limit(12).collect()]
    german = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'de'").limit(12).collect()]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(english)] + [(100 + i, t, "de", None, None) for i, t in enumerate(german)]
    rows += [(None, english[0], "en", None, 1), (7, None, None, None, None), (0, english[0], "en", "s", 1), (300, "", "en", "s", 0), (301, "½ 12", "en", "s", 0)]
    path = folder(rows, [(1, None), (None, "a b"), (2, "")])
    frame = spark.read.parquet(f"{path}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        extra = frame.withColumn("marks", F.lit(1)).withColumn("n_hit", F.lit("x")).withColumn("SCORE", F.lit(2.0))
        frame = stage(function(spark, extra, path), name)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert frame.filter("text is null or text = ''").count() == 0 or name != "line_dedup"
    assert frame.filter("doc_id is null").count() == 1  # a row without an id belongs to no group
    assert frame.filter("doc_id = 0").count() == 2  # equal rows of one id stay together
    assert corpus_pipeline.run(spark, path).count() > 0
    empty = folder([])
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_documents_without_a_labelled_row_are_refused(spark, folder):
    path = folder([(1, "some text", None, "s", 9), (2, "more text", None, "s", 9)])
    with pytest.raises(ValueError, match="label"):
        corpus_pipeline.run(spark, path)
