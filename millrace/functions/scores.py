"""Column expressions for errors and probabilities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The shift applied to a probability of exactly 0 or 1, and the bound on
# the raw score before the sigmoid.
LOG_LOSS_SHIFT = 10e-12
RAW_SCORE_BOUND = 20.0


def squared_error(label: Column, prediction: Column) -> Column:
    return F.pow(label - prediction, F.lit(2.0))


def rmse(label: Column, prediction: Column) -> Column:
    """Aggregate: root of the mean squared error over the rows at hand."""
    return F.sqrt(F.avg(squared_error(label, prediction)))


def log_loss(probability: Column, label: Column) -> Column:
    """Loss of one row for labels 1 and 0; NULL for any other label."""
    shifted = (
        F.when(probability == 0.0, probability + LOG_LOSS_SHIFT)
        .when(probability == 1.0, probability - LOG_LOSS_SHIFT)
        .otherwise(probability)
    )
    return F.when(label == 1.0, -F.log(shifted)).when(label == 0.0, -F.log(1.0 - shifted))


def probability(raw_score: Column) -> Column:
    """Sigmoid of the raw score held within the bound."""
    held = F.greatest(F.least(raw_score, F.lit(RAW_SCORE_BOUND)), F.lit(-RAW_SCORE_BOUND))
    return 1.0 / (1.0 + F.exp(-held))


def count_bucket(count: Column) -> Column:
    """Smallest power of two not below the count, or -1 above 1024."""
    return (
        F.when(count > 1024, F.lit(-1))
        .otherwise(F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(count, F.lit(1))))))
        .cast("int")
    )
