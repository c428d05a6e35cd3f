import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SAMPLE = ["top_words", "numbered_lines", "top_failing_endpoints", "daily_avg_requests", "tfidf",
          "product_csv_parse", "sort_composite", "rating_rmse", "linear_fit_grid", "one_hot",
          "feature_hash_narrow", "roc_curve", "series_blocks", "covariance"]


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert 0 < entry.entry(spark).count() <= 10


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_twin(spark, name):
    from tools.check_twins import TABLES, tidy

    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = tidy(entry.queries()[name](spark, SF).toPandas())
    want = tidy(duck.sql(entry.oracle_sql()[name]).df())
    assert got.equals(want)


@pytest.mark.parametrize("missing", ["ahocorasick", "corpus_pipeline", "millrace.llm"])
def test_other_queries_are_there_without_the_corpus_ones(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, check=True)
    queries, twins = (x.split() for x in run.stdout.splitlines()[-2:])
    assert "word_count" in queries and not any(q.startswith("op") or q == "pipeline" for q in queries)
    assert set(twins) <= set(queries)
