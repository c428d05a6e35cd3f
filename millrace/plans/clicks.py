"""Click rows: one-hot and hashed features, log loss, logistic models, ROC."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scores import log_loss, probability
from millrace.operators import classify as C
from millrace.operators import features as E
from millrace.operators.ordering import key_split
from millrace.plans import inputs as I
from millrace.session import settle

SHARES = {"train": 8, "validation": 1, "test": 1}
BUCKETS = 2**15
INTERCEPT = -1.0
GRID_STEPS = 500
ONE_HOT_STEPS = 50
TEST_GRID_STEPS = 50
WIDE_STEPS = 8
GRID = [(s, r) for s in (1.0, 10.0) for r in (1e-6, 1e-3)]


def _listed(sparse):
    """A sparse row as text, `place:value` in place order."""
    pairs = F.transform(
        F.arrays_zip("indices", "values"),
        lambda z: F.concat_ws(":", z["indices"].cast("string"), z["values"].cast("int").cast("string")),
    )
    return sparse.select("row_id", "label", F.concat_ws(" ", pairs).alias("features"))


def _stored(spark, sf_dir):
    """The parsed rows, written once for the queries that go over them several times."""
    return settle(I.click_rows(spark, sf_dir))


def _parts(spark, sf_dir):
    return key_split(_stored(spark, sf_dir), ["row_id"], SHARES)


def _labels(spark, sf_dir):
    """The split labels alone, for queries that go over the rows once."""
    return key_split(I.click_rows(spark, sf_dir).select("row_id", "label"), ["row_id"], SHARES)


def _part(parts, name):
    return parts.filter(F.col("split") == name).drop("split")


def click_parse(spark, sf_dir):
    """Uses of each (position, category) among positive and negative rows."""
    rows = I.click_rows(spark, sf_dir).select("label", F.inline("feats"))
    return rows.groupBy("label", "idx", "cat").agg(F.count(F.lit(1)).alias("n"))


def categories_per_feature(spark, sf_dir):
    return E.categories_per_feature(I.click_rows(spark, sf_dir)).orderBy("idx")


def feature_dictionary(spark, sf_dir):
    return E.feature_dictionary(I.click_rows(spark, sf_dir)).select("idx", "cat", "ordinal")


def one_hot(spark, sf_dir):
    rows = _stored(spark, sf_dir)
    return _listed(E.one_hot(rows, E.feature_dictionary(rows)))


def one_hot_unseen(spark, sf_dir):
    """Validation rows under the training dictionary, unseen categories skipped."""
    parts = _parts(spark, sf_dir)
    dictionary = E.feature_dictionary(_part(parts, "train"))
    return _listed(E.one_hot(_part(parts, "validation"), dictionary))


def feature_count_buckets(spark, sf_dir):
    return E.count_bucket_histogram(E.feature_counts(I.click_rows(spark, sf_dir)))


def nnz_total(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    dictionary = E.feature_dictionary(_part(parts, "train"))
    return E.nonzeros(E.one_hot(_part(parts, "validation"), dictionary))


def sparsity(spark, sf_dir):
    """Mean share of non-zero places, one-hot and hashed."""
    rows = _stored(spark, sf_dir)
    dictionary = E.feature_dictionary(rows)
    width = dictionary.agg(F.count(F.lit(1))).scalar()
    hot = E.sparsity(E.one_hot(rows, dictionary), width).select(F.lit("one_hot").alias("kind"), "sparsity")
    hashed = E.sparsity(E.hashed(rows, BUCKETS), F.lit(BUCKETS)).select(F.lit("hashed").alias("kind"), "sparsity")
    return hot.unionByName(hashed).select("kind", F.round("sparsity", 12).alias("sparsity"))


def first_rows_nonzeros(spark, sf_dir):
    """Non-zero places in the first twenty hashed rows."""
    first = I.click_rows(spark, sf_dir).orderBy("row_id").limit(20)
    return E.first_rows_total(E.hashed(first, BUCKETS), F.size("indices"), 20)


def feature_hash(spark, sf_dir):
    return _listed(E.hashed(I.click_rows(spark, sf_dir), BUCKETS))


def feature_hash_narrow(spark, sf_dir):
    """Hashing to 7 places, where features collide and add up."""
    return _listed(E.hashed(I.click_rows(spark, sf_dir), 7))


def class_fraction(spark, sf_dir):
    return _labels(spark, sf_dir).groupBy("split").agg(
        F.round(F.avg((F.col("label") == 1).cast("double")), 9).alias("positive_share")
    )


def baseline_logloss(spark, sf_dir):
    base = C.baseline_log_loss(_labels(spark, sf_dir))
    return base.select("split", "n", F.round("loss", 9).alias("loss"))


def _fixed_scores(spark, sf_dir):
    """Raw scores of the one-hot rows under weights that follow from the ordinal."""
    rows = _stored(spark, sf_dir)
    dictionary = E.feature_dictionary(rows)
    weights = dictionary.select("ordinal", ((F.col("ordinal") % 7 - 3) / 10.0).alias("weight"))
    return E.weighted_scores(rows, dictionary, weights, INTERCEPT)


def fixed_weight_scores(spark, sf_dir):
    scored = _fixed_scores(spark, sf_dir)
    p = probability(F.col("raw_score"))
    return scored.select(
        "row_id",
        F.round(p, 9).alias("p"),
        F.round(log_loss(p, F.col("label")), 9).alias("loss"),
    )


def fixed_weight_logloss(spark, sf_dir):
    scored = _fixed_scores(spark, sf_dir)
    return scored.agg(F.round(C.mean_log_loss(scored), 9).alias("loss"))


def one_hot_strict(spark, sf_dir):
    """What strict encoding of the rows of `test` under the dictionary of small parts would refuse:
    rows, uses of unseen features, and how many features those are."""
    rows = key_split(_stored(spark, sf_dir).filter("feats[4].cat is not null"), ["row_id"], SHARES)
    known = _part(rows, "train").filter("cast(feats[4].cat as int) <= 40")
    test = _part(rows, "test")
    unseen = E.unseen_features(test, E.feature_dictionary(known))
    counted = unseen.groupBy("idx", "cat").agg(F.count(F.lit(1)).alias("n"))
    total = test.agg(F.count(F.lit(1))).scalar()
    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("unseen_uses"), F.count(F.lit(1)).alias("unseen_features"),
    ).withColumn("n_rows", total)


def _hashed_grid(spark, sf_dir, iterations):
    """The parts, the grid and its best model. Rows are split and counted as they are parsed; only unlike
    ones are stored and hashed."""
    parts = settle(E.counted_rows(key_split(I.click_rows(spark, sf_dir), ["row_id"], SHARES), "split"))
    train, validation = (E.hashed(_part(parts, name), BUCKETS) for name in ("train", "validation"))
    return parts, *C.logistic_grid(train, validation, GRID, iterations)


def logistic_fit_grid(spark, sf_dir, iterations=GRID_STEPS):
    """Validation log loss of hashed-feature models over steps and penalties."""
    _, grid, _ = _hashed_grid(spark, sf_dir, iterations)
    return grid.withColumn("loss", F.round("loss", 6))


def logistic_grid_test(spark, sf_dir, iterations=TEST_GRID_STEPS):
    """Test log loss of the model that the validation rows choose, beside the baseline's."""
    parts, _, model = _hashed_grid(spark, sf_dir, iterations)
    scored = C.with_raw_score(E.hashed(_part(parts, "test"), BUCKETS), model)
    loss = scored.agg(C.mean_log_loss(scored).alias("e")).first()["e"]
    base = C.baseline_log_loss(parts).filter("split = 'test'")
    return base.select("n", F.round("loss", 6).alias("baseline_loss"), F.round(F.lit(loss), 6).alias("model_loss"))


def _one_hot_model(spark, sf_dir, iterations, held=C.HELD_WEIGHTS):
    parts = _parts(spark, sf_dir)
    dictionary = settle(E.feature_dictionary(_part(parts, "train")))
    model = C.descend(E.one_hot(_part(parts, "train"), dictionary), [(10.0, 1e-6)], iterations, held)
    return parts, dictionary, model


def logistic_one_hot(spark, sf_dir, iterations=ONE_HOT_STEPS):
    """Training and validation log loss of the one-hot model, with predictions summed."""
    parts, dictionary, model = _one_hot_model(spark, sf_dir, iterations)
    rated = parts.filter("split <> 'test'").drop("split")
    scored = C.with_raw_score(E.one_hot(rated, dictionary), model)
    named = key_split(scored, ["row_id"], SHARES)
    return named.groupBy("split").agg(
        F.round(C.mean_log_loss(named), 6).alias("loss"),
        F.round(F.sum(probability(F.col("raw_score"))), 4).alias("expected_positives"),
    )


def logistic_roc_auc(spark, sf_dir, iterations=ONE_HOT_STEPS):
    """Area under the curve of the one-hot model's validation scores."""
    parts, dictionary, model = _one_hot_model(spark, sf_dir, iterations)
    scored = C.with_raw_score(E.one_hot(_part(parts, "validation"), dictionary), model)
    rounded = scored.withColumn("score", F.round("raw_score", 7))  # equal rows have equal scores
    return C.area_under_curve(rounded, "score", "label").withColumn("auc", F.round("auc", 9))


def logistic_wide_weights(spark, sf_dir, iterations=WIDE_STEPS):
    """Weights of the one-hot model kept as a table, as for dictionaries that no task holds."""
    _, _, table = _one_hot_model(spark, sf_dir, iterations, held=0)
    return table.weights.select("slot", F.round(F.get("w", F.lit(0)), 9).alias("weight"))


def roc_auc(spark, sf_dir):
    scored = I.score_rows(spark, sf_dir)
    return C.area_under_curve(scored, "score", "label").withColumn("auc", F.round("auc", 9))


def roc_curve(spark, sf_dir):
    points = C.roc_points(I.score_rows(spark, sf_dir), "score", "label", "doc_id")
    rates = [F.round(c, 9).alias(c) for c in ("tpr", "fpr")]
    return points.select("doc_id", "score", "tp", "fp", *rates)


QUERIES = {
    f.__name__: f
    for f in (
        click_parse, categories_per_feature, feature_dictionary, one_hot, one_hot_unseen,
        feature_count_buckets, nnz_total, sparsity, first_rows_nonzeros, feature_hash,
        feature_hash_narrow, class_fraction, baseline_logloss, fixed_weight_scores,
        fixed_weight_logloss, one_hot_strict, logistic_fit_grid, logistic_grid_test, logistic_one_hot,
        logistic_roc_auc, logistic_wide_weights, roc_auc, roc_curve,
    )
}
