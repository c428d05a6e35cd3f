from __future__ import annotations

import pyspark.sql.functions as F

from millrace.llm import decontamination


def test_parts_count_words_with_capitals_as_one_automaton_does(spark, monkeypatch):
    words = [f"Word{chr(97 + i % 26)} iPhone{i} THE 日{i}" for i in range(40)]
    passage = " ".join(words)
    texts = [passage, passage.upper(), "AN OTHER START " + passage.swapcase() + " The End", "ALL CAPITALS " * 20, "THE END OF WORDS", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words[:20])), (2, " ".join(words[8:30])), (3, "all capitals all"), (4, "The End")], "item_id long, text string")

    def found():
        rows = decontamination.find_contamination(docs, items).withColumn("contaminated", F.col("n_hit") > 0)
        return {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in rows.collect()}

    whole = found()
    assert [whole[i][1] for i in range(6)] == [120, 120, 122, 39, 2, 0]
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", 2000)
    assert found() == whole
