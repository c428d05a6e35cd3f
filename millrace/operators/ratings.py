"""Rating tables (usr, item, rating): averages, errors, ALS and recommendation."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scores import rmse
from millrace.functions.text import rating_key


def item_averages(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.avg("rating").alias("mean_rating")
    )


def named_averages(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """(mean_rating, title, n) per rated item that has a title. One row per item meets
    one title, so no key is hot; Spark picks the join by size."""
    return items.join(item_averages(ratings), "item").select("mean_rating", "title", "n")


def well_rated(named: DataFrame, min_support: int, limit: int | None = None) -> DataFrame:
    """Items with more than `min_support` ratings, best first by the composite text key."""
    keyed = named.filter(F.col("n") > min_support).withColumn(
        "sort_key", rating_key(F.col("mean_rating"), F.col("title"))
    )
    ordered = keyed.orderBy(F.desc("sort_key"))
    return ordered if limit is None else ordered.limit(limit)


def prediction_rmse(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """RMSE over the rows the two tables pair up on (usr, item).

    Each side is first combined to count, mean and spread per key, from which the
    squared differences of all its pairings follow; repeated keys are never multiplied
    out.
    """

    keys = ["usr", "item"]
    return _paired_rmse(predicted.groupBy(*keys).agg(*_spread("prediction", "p")).join(
        actual.groupBy(*keys).agg(*_spread("rating", "a")), keys))


def model_rmse(model: ALSModel, actual: DataFrame) -> DataFrame:
    """`prediction_rmse` of a model's own predictions for `actual`, whose ratings travel with the pairs:
    the joins with the factors leave a pair's rows together, so nothing is shuffled or joined again."""
    scored = model.transform(actual.select("usr", "item", "rating"))
    return _paired_rmse(scored.groupBy("usr", "item").agg(*_spread("prediction", "p"), *_spread("rating", "a")))


def _spread(value: str, tag: str) -> list[Column]:
    value = F.col(value).cast("double")
    return [F.count(F.lit(1)).alias(f"_n{tag}"), F.avg(value).alias(f"_m{tag}"), F.var_pop(value).alias(f"_v{tag}")]


def _paired_rmse(paired: DataFrame) -> DataFrame:
    rows = F.col("_np") * F.col("_na")
    squares = rows * (F.pow(F.col("_mp") - F.col("_ma"), F.lit(2)) + F.col("_vp") + F.col("_va"))
    return paired.agg(
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("n"),
        F.sqrt(F.try_divide(F.sum(squares), F.sum(rows))).alias("rmse"),
    )


def mean_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE on `test` of always predicting the mean training rating."""
    mean = train.agg(F.avg("rating")).scalar()
    return test.withColumn("_mean", mean).agg(
        F.first("_mean").alias("train_mean"), rmse(F.col("rating"), F.col("_mean")).alias("rmse")
    )


def unrated_items(items: DataFrame, own_ratings: DataFrame, usr: Column) -> DataFrame:
    """(usr, item) for the items the user has not rated."""
    return items.join(own_ratings.select("item").distinct(), "item", "left_anti").select(
        usr.cast("int").alias("usr"), "item"
    )


def fit_als(
    ratings: DataFrame, rank: int, iterations: int = 5, reg: float = 0.1, seed: int = 5,
    blocks: int = 10,
) -> ALSModel:
    """`blocks` sets how many pieces users and items are cut into; raise it with the
    cluster so that one block's factors fit a task."""
    als = ALS(
        rank=rank, maxIter=iterations, regParam=reg, seed=seed,
        numUserBlocks=blocks, numItemBlocks=blocks,
        userCol="usr", itemCol="item", ratingCol="rating", coldStartStrategy="drop",
    )
    return als.fit(ratings)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """(usr, item, prediction) for the asked pairs; unknown users or items drop out."""
    return model.transform(pairs.select("usr", "item"))


def rank_grid(
    train: DataFrame, validation: DataFrame, ranks: tuple[int, ...] = (4, 8, 12), **als
) -> tuple[DataFrame, ALSModel]:
    """(rank, n, rmse, best) on the validation part, one row per rank, and the model
    with the lowest error."""
    spark = train.sparkSession
    train = train.persist()
    try:
        tried = []
        for rank in ranks:
            model = fit_als(train, rank, **als)
            row = model_rmse(model, validation).first()
            tried.append((rank, row["n"], row["rmse"], model))
    finally:
        train.unpersist()
    best = min(tried, key=lambda t: float("inf") if t[2] is None else t[2])  # nothing predicted: no error
    rows = [(rank, n, error, rank == best[0]) for rank, n, error, _ in tried]
    return spark.createDataFrame(rows, "rank int, n bigint, rmse double, best boolean"), best[3]


def supported(candidates: DataFrame, ratings: DataFrame, min_support: int) -> DataFrame:
    """`candidates` (usr, item) with n, the item's ratings, where these are more than `min_support`."""
    counts = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return candidates.select("usr", "item").join(counts.filter(F.col("n") > min_support), "item")


def recommend(
    model: ALSModel, candidates: DataFrame, ratings: DataFrame, min_support: int, limit: int
) -> DataFrame:
    """Best predictions among `candidates` for items with more than `min_support` ratings. Only these
    are predicted."""
    kept = supported(candidates, ratings, min_support)
    return (
        model.transform(kept)
        .select("usr", "item", F.col("prediction").cast("double").alias("prediction"), "n")
        .orderBy(F.desc("prediction"), "item")
        .limit(limit)
    )


