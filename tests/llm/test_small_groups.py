from __future__ import annotations

import random

import pyspark.sql.functions as F

from millrace.llm import quality
from millrace.llm.frames import read_table
from millrace.llm.registered import op3_quality


def test_junk_in_a_group_of_a_few_rows_goes(spark):
    rng = random.Random(8)
    prose = lambda: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(80, 200)))
    junk = lambda: " ".join("".join(rng.choices("abc#$%&*|", k=rng.randint(2, 9))) for _ in range(100))
    rows = [(i, prose(), "en", "large") for i in range(120)]
    # the language has enough rows; neither source nor language has; no values at all
    for lang, source in (("en", "few"), ("xx", "few"), (None, None)):
        rows += [(len(rows) + i, junk() if i == 0 else prose(), lang, source) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert len(found) == len(rows)
    assert all(not r["base_failed"] and r["distance"] is not None for r in found.values())
    assert {i for i, r in found.items() if not r["kept"]} == {120, 124, 128}
    few = quality.judge(docs.filter("lang is null")).collect()
    assert all(r["distance"] is not None for r in few)


def test_query_judges_every_document_where_all_groups_are_small(spark):
    labels = read_table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", "quality")
    rows = op3_quality(spark, "/root/testdata/sf0.01").filter("not base_failed").join(labels, "doc_id")
    found = {r["quality"]: r for r in rows.groupBy("quality").agg(
        F.count("*").alias("n"), F.count("distance").alias("judged"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    print(found)
    assert all(r["n"] == r["judged"] for r in found.values())
    assert found[1]["kept"] > 0.99 and found[0]["kept"] < 0.3
