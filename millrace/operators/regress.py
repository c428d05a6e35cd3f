"""Least-squares models on (label, features).

For squared loss the gradient is X'Xw - X'y and the error follows from the same sums,
so every descent below makes one pass over the data (`regression_moments`) and then works on
a small matrix, with the iterates that a pass per step would give in exact numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from millrace.functions import arrays as A
from millrace.functions.scores import rmse
from millrace.operators.moments import Moments, regression_moments


@dataclass(frozen=True)
class LinearModel:
    weights: np.ndarray
    intercept: float


def shift_labels(df: DataFrame) -> DataFrame:
    """Labels moved so that the least is 0."""
    return df.withColumn("label", F.col("label") - df.agg(F.min("label")).scalar())


def gradient_total(df: DataFrame, weights) -> DataFrame:
    """(pos, gradient): the rows' least-squares gradients summed per position."""
    per_row = A.gradient_summand(A.literal_array(weights), F.col("features"), F.col("label"))
    return df.select(F.posexplode(per_row).alias("pos", "g")).groupBy("pos").agg(
        F.sum("g").alias("gradient")
    )


def with_prediction(df: DataFrame, model: LinearModel) -> DataFrame:
    score = A.dot(F.col("features"), A.literal_array(model.weights)) + F.lit(float(model.intercept))
    return df.withColumn("prediction", score)


def model_rmse(df: DataFrame, model: LinearModel) -> float:
    scored = with_prediction(df, model)
    return scored.agg(rmse(F.col("label"), F.col("prediction")).alias("e")).first()["e"]


def batch_descent(moments: Moments, iterations: int) -> tuple[np.ndarray, list[float]]:
    """Full-batch descent with step 1 / (n sqrt(i + 1)) from zero weights; returns the
    weights and the RMSE before each update."""
    w = np.zeros(len(moments.xy))
    errors = []
    for i in range(iterations):
        pull = moments.xx @ w
        mse = (w @ pull - 2 * w @ moments.xy + moments.yy) / moments.rows
        errors.append(float(np.sqrt(max(mse, 0.0))))
        w = w - (pull - moments.xy) / (moments.rows * np.sqrt(i + 1))
    return w, errors


def sgd_fit(moments: Moments, iterations: int, step: float, reg: float) -> LinearModel:
    """Full-batch SGD with L2 and an intercept. `moments` must include the constant
    column, which starts at 1 and is shrunk like any weight; the step at t is
    step / sqrt(t).

    Along an eigenvector of X'X / n with value v, a step multiplies what is missing to the fixed
    point by 1 - rate (v + reg). So the weights after all steps are products, one a vector, and
    keep their digits also where the iterates grow without bound and come back.
    """
    values, vectors = np.linalg.eigh(moments.xx / moments.rows)
    start = np.zeros(len(values))
    start[-1] = 1.0
    begun, pull = vectors.T @ start, vectors.T @ moments.xy / moments.rows
    curve = values + reg
    flat = np.abs(curve) <= 1e-14 * max(np.abs(values).max(), 1e-300)
    fixed = np.where(flat, begun, pull / np.where(flat, 1.0, curve))  # a flat direction has no pull
    rates = step / np.sqrt(np.arange(1, iterations + 1))
    factors = 1 - rates[:, None] * curve
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        left = np.prod(np.sign(factors), axis=0) * np.exp(np.log(np.abs(factors)).sum(axis=0))
        w = vectors @ (fixed + (begun - fixed) * left)
    return LinearModel(w[:-1], float(w[-1]))


def sgd_grid(
    train: DataFrame, validation: DataFrame, settings: list[tuple[int, float, float]]
) -> tuple[DataFrame, LinearModel]:
    """(iterations, step, reg, rmse, diverged, best) on the validation part for each setting, and
    the best model. A model has diverged if its error is above that of the starting weights; beyond
    the range of numbers it is infinite. The training rows are read once for the whole grid."""
    moments = regression_moments(train, intercept=True)
    models = [sgd_fit(moments, *setting) for setting in settings]
    start = LinearModel(np.zeros(len(moments.xy) - 1), 1.0)
    errors = [
        rmse(
            F.col("label"),
            A.dot(F.col("features"), A.literal_array(m.weights)) + F.lit(m.intercept),
        ).alias(f"e{k}")
        for k, m in enumerate([*models, start])
    ]
    *found, begun = [float("inf") if e is None or np.isnan(e) else float(e) for e in validation.agg(*errors).first()]
    best = min(range(len(found)), key=lambda k: found[k])
    rows = [
        (int(it), float(step), float(reg), found[k], found[k] > begun, k == best)
        for k, (it, step, reg) in enumerate(settings)
    ]
    schema = "iterations int, step double, reg double, rmse double, diverged boolean, best boolean"
    return train.sparkSession.createDataFrame(rows, schema), models[best]


def mean_label_baseline(parts: DataFrame) -> DataFrame:
    """(split, n, rmse) of always predicting the mean label of the 'train' rows."""
    mean = parts.filter("split = 'train'").agg(F.avg("label")).scalar()
    return parts.withColumn("_mean", mean).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), rmse(F.col("label"), F.col("_mean")).alias("rmse")
    )
