import math
import warnings
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import classify as C
from millrace.operators import components as P
from millrace.operators import moments as M
from millrace.operators import regress as L
from millrace.functions.scores import rmse

# The literal inputs and expected results below are those to be matched


def labelled(spark, x, y):
    rows = [(float(b), [float(v) for v in a]) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "label double, features array<double>").repartition(3)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = rng.random((200, 3))
    return x, x @ [3.0, -2.0, 1.0] + 4 + rng.normal(0, 0.1, 200)


def test_rmse(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0), (2.0, 2.0)], "y double, p double")
    assert df.agg(rmse(F.col("y"), F.col("p"))).first()[0] == pytest.approx(1.29099444874)


def test_label_shift_and_prediction(spark):
    df = labelled(spark, [[1.0, 0.5], [0.5, 0.5]], [2.0, 1.5])
    assert sorted(r["label"] for r in L.shift_labels(df).collect()) == [0.0, 0.5]
    scored = L.with_prediction(df, L.LinearModel(np.array([1.0, 1.5]), 0.0))
    assert {(r["label"], r["prediction"]) for r in scored.collect()} == {(2.0, 1.75), (1.5, 1.25)}


def test_batch_descent_equals_a_pass_per_step(spark, data):
    x, y = data
    w, want = np.zeros(3), []
    for i in range(50):
        want.append(math.sqrt(((x @ w - y) ** 2).mean()))
        w = w - x.T @ (x @ w - y) / (len(y) * math.sqrt(i + 1))
    got, errors = L.batch_descent(M.regression_moments(labelled(spark, x, y)), 50)
    assert got == pytest.approx(w) and errors == pytest.approx(want)


def test_sgd_equals_the_library(spark, data):
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

    x, y = data
    points = spark.sparkContext.parallelize([LabeledPoint(b, Vectors.dense(a)) for a, b in zip(x, y)], 2)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        library = LinearRegressionWithSGD.train(
            points, 30, 1.0, 1.0, regParam=0.1, regType="l2", intercept=True, convergenceTol=0.0)
    moments = M.regression_moments(labelled(spark, x, y), intercept=True)
    mine = L.sgd_fit(moments, 30, 1.0, 0.1)
    assert mine.weights == pytest.approx(library.weights.toArray(), abs=1e-7)
    assert mine.intercept == pytest.approx(library.intercept, abs=1e-7)


def test_sgd_grid_picks_the_lowest_error(spark, data):
    x, y = data
    train, held = labelled(spark, x[:150], y[:150]), labelled(spark, x[150:], y[150:])
    grid, model = L.sgd_grid(train, held, [(5, 1e-5, 0.0), (200, 1.0, 1e-10), (200, 1.0, 1.0)])
    rows = grid.collect()
    best = [r for r in rows if r["best"]]
    assert len(best) == 1 and best[0]["rmse"] == min(r["rmse"] for r in rows)
    assert L.model_rmse(held, model) == pytest.approx(best[0]["rmse"])
    parts = train.withColumn("split", F.lit("train")).unionByName(held.withColumn("split", F.lit("test")))
    base = {r["split"]: r["rmse"] for r in L.mean_label_baseline(parts).collect()}
    assert best[0]["rmse"] < base["test"]


def sparse(spark, rows):
    return spark.createDataFrame(rows, "row_id int, label double, indices array<int>, values array<double>")


@pytest.fixture(scope="module")
def clicks():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        places = sorted(int(p) for p in rng.choice(8, rng.integers(0, 4), replace=False))
        label = float(rng.random() < 1 / (1 + math.exp(1 - 2 * (3 in places))))
        rows.append((i, label, places, [float(v) for v in rng.integers(1, 3, len(places))]))
    return rows


def test_logistic_descent_equals_the_library(spark, clicks):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.regression import LabeledPoint

    points = spark.sparkContext.parallelize(
        [LabeledPoint(y, Vectors.sparse(8, i, v)) for _, y, i, v in clicks], 2)
    settings = [(1.0, 1e-3), (5.0, 1e-6)]
    mine = C.descend(sparse(spark, clicks).repartition(3), settings, 12)
    for (step, reg), model in zip(settings, mine):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            library = LogisticRegressionWithSGD.train(
                points, 12, step, 1.0, regParam=reg, regType="l2", intercept=True, convergenceTol=0.0)
        assert model.dense(8) == pytest.approx(library.weights.toArray(), abs=1e-7)
        assert model.intercept == pytest.approx(library.intercept, abs=1e-7)


def test_weights_in_a_table_take_the_same_steps(spark, clicks):
    """Also with rows that lack a label or have no place, far places, and pieces of few rows."""
    far = [(i, y, [p + (1 << 40) * (p > 5) for p in places], v) for i, y, places, v in clicks]
    frame = spark.createDataFrame(
        [*far, (900, None, [1], [1.0]), (901, 1.0, None, None)], "row_id int, label double, indices array<bigint>, values array<double>")
    settings = [(1.0, 1e-3), (5.0, 1e-6)]
    held = C.descend(frame, settings, 6)
    table = C.descend(frame, settings, 6, held=3)
    assert isinstance(table, C.ModelTable)
    weights = {r["slot"]: r["w"] for r in table.weights.collect()}
    for m, model in enumerate(held):
        assert weights[C.INTERCEPT][m] == pytest.approx(model.intercept, abs=1e-12)
        assert [weights[p][m] for p in model.places.tolist()] == pytest.approx(model.weights.tolist(), abs=1e-12)
    assert set(weights) == {C.INTERCEPT, *held[0].places.tolist()}
    rows = frame.filter("indices is not null")
    names = ["a", "b"]
    one = {r["row_id"]: (r["a"], r["b"]) for r in C.with_raw_scores(rows, held, names).collect()}
    two = {r["row_id"]: (r["a"], r["b"]) for r in C.with_raw_scores(rows, table, names).collect()}
    assert one.keys() == two.keys() and all(two[k] == pytest.approx(v, abs=1e-12) for k, v in one.items())
    grid, best = C.logistic_grid(frame, rows.filter("label is not null"), settings, 6, held=3)
    assert best.models == 1 and [r["loss"] for r in grid.collect()] == pytest.approx(C.model_log_losses(rows.filter("label is not null"), held))


def test_gradients_of_many_tasks_are_added_in_levels(spark, clicks, monkeypatch):
    monkeypatch.setattr(C, "MEETING", 2)
    monkeypatch.setattr(C, "PIECE_ENTRIES", 9)
    frame = sparse(spark, clicks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = C.descend(frame, [(1.0, 1e-3)], 5)[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert many.weights == pytest.approx(C.descend(frame, [(1.0, 1e-3)], 5)[0].weights, abs=1e-12)


def test_logistic_grid_beats_the_baseline(spark, clicks):
    rows = sparse(spark, clicks)
    grid, model = C.logistic_grid(rows, rows, [(1.0, 1e-6), (1.0, 10.0)], 30)
    best = grid.filter("best").first()
    assert best["loss"] == grid.agg(F.min("loss")).first()[0]
    base = C.baseline_log_loss(rows.withColumn("split", F.lit("train"))).first()
    assert best["loss"] < base["loss"]
    p = sum(r[1] for r in clicks) / len(clicks)
    assert base["loss"] == pytest.approx(-(p * math.log(p) + (1 - p) * math.log(1 - p)))


def test_sparse_score_equals_dense_dot(spark):
    rows = sparse(spark, [(1, 0.0, [1, 3], [3.0, 4.0]), (2, 0.0, [3], [1.0]), (3, 0.0, [], [])])
    model = C.LogisticModel(np.array([0.4, 3.1, -1.4, -0.5]), 0.25)
    got = {r["row_id"]: r["raw_score"] for r in C.with_raw_score(rows, model).collect()}
    assert got == pytest.approx({1: 7.3 + 0.25, 2: -0.5 + 0.25, 3: 0.25})


def test_roc(spark):
    rows = [(i, (i * 37 % 10) / 10, float(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, s double, y double")
    got = {r["id"]: r for r in C.roc_points(df, "s", "y", "id").collect()}
    positives = sum(r[2] for r in rows)
    tp = fp = 0
    for i, _, y in sorted(rows, key=lambda r: (-r[1], r[0])):
        tp, fp = tp + int(y), fp + int(1 - y)
        assert (got[i]["tp"], got[i]["fp"]) == (tp, fp)
        assert got[i]["tpr"] == tp / positives and got[i]["fpr"] == fp / (60 - positives)


def vectors(spark, rows):
    return spark.createDataFrame([([float(v) for v in r],) for r in rows], "features array<double>")


def test_components_of_the_ramp(spark):
    rows = [list(range(x, x + 4)) for x in range(0, 20, 4)]
    df = vectors(spark, rows)
    found = P.fit_components(df, 3)
    assert found.directions[:, 0] == pytest.approx([0.5] * 4)
    assert found.eigenvalues == pytest.approx([128, 0, 0, 0], abs=1e-9)
    scores = [r["scores"] for r in P.with_scores(df, found).collect()]
    assert min(abs(s[0]) for s in scores) == pytest.approx(3.0)
    assert found.variance_explained(1) == pytest.approx(1.0)


def test_covariance_and_components_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.multivariate_normal([50, 50, 50], [[25, 9, 3], [9, 16, 1], [3, 1, 9]], 300)
    df = vectors(spark, x)
    want = np.cov(x.T, bias=True)
    got = {(r["i"], r["j"]): r["cov"] for r in M.covariance(df).collect()}
    assert got == pytest.approx({(i, j): want[i, j] for i in range(3) for j in range(3)})
    assert M.mean_vector(df) == pytest.approx(list(x.mean(axis=0)))
    values, directions = np.linalg.eigh(want)
    found = P.fit_components(df, 2)
    assert found.eigenvalues == pytest.approx(values[::-1])
    for k in range(2):
        v = directions[:, 2 - k]
        assert found.directions[:, k] == pytest.approx(v * np.sign(v[np.abs(v).argmax()]))
    assert found.variance_explained(2) == pytest.approx(values[::-1][:2].sum() / values.sum())


def test_components_of_wide_vectors_by_iteration(spark):
    """5000 places, of which no 5000 x 5000 matrix is made, beside numpy; and on few places beside the library."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 4)) * [9, 6, 4, 2] @ rng.normal(size=(4, 5000)) + 0.01 * rng.normal(size=(40, 5000)) + 3
    df = vectors(spark, x).repartition(3)
    found = P.fit_components(df, 2)
    _, values, rows = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert found.eigenvalues == pytest.approx(values[:2] ** 2 / 40)
    assert found.total == pytest.approx((values**2).sum() / 40)
    for k in range(2):
        assert abs(rows[k] @ found.directions[:, k]) == pytest.approx(1, abs=1e-9)
        assert found.directions[np.abs(found.directions[:, k]).argmax(), k] > 0
    with pytest.raises(ValueError):
        found.variance_explained(3)
    y = rng.multivariate_normal([5, 0, 1, 2], [[25, 9, 3, 0], [9, 16, 1, 1], [3, 1, 9, 0], [0, 1, 0, 2]], 200)
    small = vectors(spark, y)
    library, mine = P.fit_components(small, 3), P.fit_components(small, 3, held=2)
    assert mine.eigenvalues == pytest.approx(library.eigenvalues[:3]) and mine.total == pytest.approx(library.total)
    assert np.abs(mine.directions - library.directions).max() < 1e-6


def test_scores_of_rows_with_holes(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [None, 9.0]), (4, [3.0, -4.0]), (5, [0.0, 1.0])], "id int, features array<double>")
    found = P.fit_components(df, 2)
    got = {r["id"]: r["scores"] for r in P.with_scores(df, found).collect()}
    assert got[2] is None and got[3] is None
    assert got[4] == pytest.approx((np.array([3.0, -4.0]) @ found.directions).tolist())
    assert {r["pos"]: r["mean"] for r in M.column_means(df).collect()} == pytest.approx({0: 4 / 3, 1: -1 / 3})


def test_moments_refuse_uneven_vectors_and_leave_out_nulls(spark):
    kind = "features array<double>"
    uneven = spark.createDataFrame([([1.0, 2.0, 3.0],), ([5.0],)], kind)
    with pytest.raises(ValueError, match="1 to 3"):
        M.products(uneven, ["features"])
    rows = [([1.0, 2.0],), (None,), ([None, 9.0],), ([3.0, -4.0],)]
    found = {(r["i"], r["j"]): r["total"] for r in M.products(spark.createDataFrame(rows, kind), ["features"]).collect()}
    assert found == {(0, 0): 10.0, (0, 1): -10.0, (1, 1): 20.0}
    cov = {(r["i"], r["j"]): r["cov"] for r in M.covariance(spark.createDataFrame(rows, kind)).collect()}
    assert cov == {(0, 0): 1.0, (0, 1): -3.0, (1, 0): -3.0, (1, 1): 9.0}
    assert M.products(spark.createDataFrame([], kind), ["features"]).count() == 0
    zeros = {(r["i"], r["j"]): r["total"] for r in M.products(spark.createDataFrame([([0.0, 0.0],)], kind), ["features"]).collect()}
    assert zeros == {(0, 0): 0.0, (0, 1): 0.0, (1, 1): 0.0}


@pytest.mark.parametrize("width", [1, 2, 7, 100, 4096])
def test_places_of_a_triangle(spark, width):
    size = width * (width + 1) // 2
    i, j = np.triu_indices(width)
    some = sorted({0, size - 1, *np.random.default_rng(1).integers(0, size, 300).tolist(), *(np.flatnonzero(np.diff(i)) + 1).tolist()[:4000]})
    frame = spark.createDataFrame([(int(k),) for k in some], "k long")
    got = {r["k"]: (r["i"], r["j"]) for r in frame.select("k", *M._pair_of(F.col("k"), width)).collect()}
    assert got == {k: (int(i[k]), int(j[k])) for k in some}


def test_descents_that_grow_without_bound_keep_their_digits(spark):
    rng = np.random.default_rng(4)
    data = [(float(y), [float(v) for v in x]) for x, y in zip(rng.random((200, 3)), rng.random(200), strict=True)]
    frame = spark.createDataFrame(data, "label double, features array<double>")
    settings = [(500, 30.0, 1e-10), (500, 1.0, 1e-10), (5, 30.0, 0.0), (3000, 1e4, 0.0)]
    grid, _ = L.sgd_grid(frame, frame, settings)
    rows = grid.collect()
    assert [r["diverged"] for r in rows[1:]] == [False, True, True] and rows[1]["best"] and [r["best"] for r in rows].count(True) == 1
    moments = M.regression_moments(frame, intercept=True)
    x, y = np.array([[*f, 1.0] for _, f in data]), np.array([v for v, _ in data])
    for (iterations, step, reg), row in zip(settings[:3], rows, strict=False):
        with localcontext() as context:  # the plain iteration with 80 digits
            context.prec = 80
            xx, xy = ([[Decimal(v) for v in r] for r in np.atleast_2d(z).tolist()] for z in (moments.xx, moments.xy))
            w = [Decimal(0)] * 3 + [Decimal(1)]
            for t in range(1, iterations + 1):
                rate = Decimal(step) / Decimal(t).sqrt()
                g = [(sum(a * b for a, b in zip(xx[i], w, strict=True)) - xy[0][i]) / moments.rows for i in range(4)]
                w = [v * (1 - rate * Decimal(reg)) - rate * d for v, d in zip(w, g, strict=True)]
            exact = np.array([float(v) for v in w])
        assert row["rmse"] == pytest.approx(float(np.sqrt(np.mean((x @ exact - y) ** 2))), rel=1e-8)
    assert rows[1]["rmse"] < 0.4 and rows[3]["rmse"] > 1e100
