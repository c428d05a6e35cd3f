"""Linear regression: label shift, descent, grids and interaction features."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.operators import regress as M
from millrace.operators.moments import regression_moments
from millrace.operators.ordering import bottom_sample, key_split
from millrace.plans import inputs as I
from millrace.sources import lines as S

SHARES = {"train": 8, "validation": 1, "test": 1}
FIXED = M.LinearModel([1.0, 1.5, -0.5], 0.0)
DESCENT_STEPS = 50
# The settings (iterations, step, penalty) whose results are matched
GRID = [(500, 1.0, 1e-10), (500, 1.0, 1e-5), (500, 1.0, 1e-1), (500, 1.0, 1.0),
        (5, 1e-5, 1e-10), (500, 1e-5, 1e-10), (5, 10.0, 1e-10), (500, 10.0, 1e-10)]
INTERACT = (500, 1.0, 1e-10)


def labelled_lines_parse(spark, sf_dir):
    """Rows written as label-first CSV and read back, in totals."""
    rows = I.regression_rows(spark, sf_dir)
    lines = rows.select(F.concat_ws(",", "label", F.concat_ws(",", F.transform("features", lambda x: x.cast("string")))).alias("value"))
    parsed = S.parse_labelled(lines).filter(F.col("status") == S.VALID)
    return parsed.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("label"), 4).alias("labels"),
        F.round(F.sum(F.get("features", F.lit(2))), 4).alias("third_features"),
    )


def label_range_shift(spark, sf_dir):
    rows = I.regression_rows(spark, sf_dir)
    shifted = M.shift_labels(rows).agg(
        F.round(F.min("label"), 6).alias("new_min"), F.round(F.max("label"), 6).alias("new_max")
    )
    old = rows.agg(F.round(F.min("label"), 6).alias("x"), F.round(F.max("label"), 6).alias("y"))
    return shifted.select(
        "new_min", "new_max",
        old.select("x").scalar().alias("old_min"), old.select("y").scalar().alias("old_max"),
    )


def shifted_labels(spark, sf_dir):
    rows = M.shift_labels(I.regression_rows(spark, sf_dir))
    return rows.select("row_id", F.round("label", 6).alias("label"))


def label_histogram(spark, sf_dir):
    rows = I.regression_rows(spark, sf_dir)
    counted = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.round("label", 6).alias("label"), "n")


def _parts(spark, sf_dir, rows=None):
    rows = I.regression_rows(spark, sf_dir) if rows is None else rows
    return key_split(rows, ["row_id"], SHARES)


def _part(parts, name):
    return parts.filter(F.col("split") == name).drop("split")


def split_totals(spark, sf_dir):
    return _parts(spark, sf_dir).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("label"), 4).alias("labels")
    )


def mean_label_rmse(spark, sf_dir):
    base = M.mean_label_baseline(_parts(spark, sf_dir))
    return base.select("split", "n", F.round("rmse", 6).alias("rmse"))


def gradient_sum(spark, sf_dir):
    total = M.gradient_total(I.regression_rows(spark, sf_dir), [1.0, 1.0, 1.0])
    return total.select("pos", F.round("gradient", 3).alias("gradient"))


def linear_predict(spark, sf_dir):
    scored = M.with_prediction(I.regression_rows(spark, sf_dir), FIXED)
    return scored.select(
        "row_id", F.round("label", 6).alias("label"), F.round("prediction", 6).alias("prediction")
    )


def interactions(spark, sf_dir):
    """Sum of each original and product feature over all rows."""
    rows = I.regression_rows(spark, sf_dir).select(
        F.posexplode(A.interactions(F.col("features"))).alias("pos", "x")
    )
    return rows.groupBy("pos").agg(F.round(F.sum("x"), 3).alias("total"))


def gd_trace(spark, sf_dir):
    """Training RMSE before each step of batch descent."""
    moments = regression_moments(_part(_parts(spark, sf_dir), "train"))
    _, errors = M.batch_descent(moments, DESCENT_STEPS)
    rows = [(i, round(e, 6)) for i, e in enumerate(errors)]
    return spark.createDataFrame(rows, "iteration int, rmse double")


def sample_slice_trace(spark, sf_dir):
    """Batch descent on two features of a sample of ten training rows."""
    train = _part(_parts(spark, sf_dir), "train")
    sample = bottom_sample(train, ["row_id"], 10).select("label", F.slice("features", 1, 2).alias("features"))
    _, errors = M.batch_descent(regression_moments(sample), 5)
    return spark.createDataFrame([(i, round(e, 6)) for i, e in enumerate(errors)], "iteration int, rmse double")


def labelled_width_counts(spark, sf_dir):
    """Lines per status where lines must have three features; the first line of an order lacks one."""
    rows = I.regression_rows(spark, sf_dir)
    short = F.split("row_id", "-")[1] == "1"
    kept = F.when(short, F.slice("features", 1, 2)).otherwise(F.col("features"))
    lines = rows.select(F.concat_ws(",", "label", F.concat_ws(",", F.transform(kept, lambda x: x.cast("string")))).alias("value"))
    return S.status_counts(S.parse_labelled(lines, 3))


def linear_grid_test(spark, sf_dir):
    """Test error of the model that the validation rows choose, beside the mean label's."""
    parts = _parts(spark, sf_dir)
    _, model = M.sgd_grid(_part(parts, "train"), _part(parts, "validation"), GRID)
    error = M.model_rmse(_part(parts, "test"), model)
    base = M.mean_label_baseline(parts).filter("split = 'test'")
    return base.select("n", F.round("rmse", 6).alias("baseline_rmse"), F.round(F.lit(error), 6).alias("model_rmse"))


def linear_fit_grid(spark, sf_dir):
    """Validation error per setting, large ones with fewer decimals."""
    parts = _parts(spark, sf_dir)
    grid, _ = M.sgd_grid(_part(parts, "train"), _part(parts, "validation"), GRID)
    return grid.withColumn("rmse", F.when(F.col("rmse") > 1000, F.round("rmse", 0)).otherwise(F.round("rmse", 6)))


def linear_interact_fit(spark, sf_dir):
    """Test error of the model on interaction features beside the mean baseline."""
    rows = I.regression_rows(spark, sf_dir).withColumn(
        "features", A.interactions(F.col("features"))
    )
    parts = _parts(spark, sf_dir, rows)
    _, model = M.sgd_grid(_part(parts, "train"), _part(parts, "validation"), [INTERACT])
    error = M.model_rmse(_part(parts, "test"), model)
    base = M.mean_label_baseline(parts).filter("split = 'test'")
    return base.select(
        "n", F.round("rmse", 6).alias("baseline_rmse"), F.round(F.lit(error), 6).alias("model_rmse")
    )


QUERIES = {
    f.__name__: f
    for f in (
        labelled_lines_parse, label_range_shift, shifted_labels, label_histogram, split_totals,
        mean_label_rmse, gradient_sum, linear_predict, interactions, gd_trace, linear_fit_grid,
        linear_grid_test, linear_interact_fit, sample_slice_trace, labelled_width_counts,
    )
}
