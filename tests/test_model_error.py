"""The error of a recommendation model on the rows that it predicts."""

import random

import pytest

from millrace.operators import ratings as R


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_model_error_needs_no_join_back(spark, no_broadcast):
    rng = random.Random(4)
    rows = [(u, i, float(rng.randint(1, 5))) for u in range(30) for i in range(20) if rng.random() < 0.5]
    frame = lambda x: spark.createDataFrame(x, "usr int, item int, rating double")
    model = R.fit_als(frame(rows), 3)
    asked = [*rows[:40], (1, 1, 5.0), *[(u, i, r + 1) for u, i, r in rows[:7]], (99, 1, 2.0), (1, 99, 3.0)]
    want = R.prediction_rmse(R.predict(model, frame(asked)), frame(asked)).first()
    found = R.model_rmse(model, frame(asked))
    got = found.first()
    assert got["n"] == want["n"] > 47 and got["rmse"] == pytest.approx(want["rmse"], rel=1e-12)
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 4  # pairs by user and by item, and both factor tables
    empty = R.model_rmse(model, frame([(99, 99, 1.0)])).first()
    assert (empty["n"], empty["rmse"]) == (0, None)
