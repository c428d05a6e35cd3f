"""Rating aggregates, errors and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ratings as R
from millrace.operators.joins import spread_join
from millrace.operators.ordering import key_split, same_rows
from millrace.operators.tokens import counted_members
from millrace.plans import inputs as I
from millrace.session import settle, shared_folder
from millrace.sources import lines as S

SHARES = {"train": 6, "validation": 2, "test": 2}
SUPPORT = 30


def rating_lines_parse(spark, sf_dir):
    """Ratings written as `::` lines and read back, in totals per status."""
    lines = I.ratings(spark, sf_dir).select(
        F.concat_ws("::", "usr", "item", "rating", F.lit("978300760")).alias("value")
    )
    return S.parse_ratings(lines).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("usr").alias("usrs"), F.sum("item").alias("items"),
        F.sum("rating").alias("ratings"),
    )


def gzip_rating_lines(spark, sf_dir):
    """Rating lines written to gzip files and read back, in totals per status."""
    lines = I.ratings(spark, sf_dir).select(F.concat_ws("::", "usr", "item", "rating", F.lit("978300760")).alias("value"))
    folder = shared_folder(spark, "gzip-ratings")
    lines.write.option("compression", "gzip").text(folder)
    return S.parse_ratings(S.read_compressed_lines(spark, folder)).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("usr").alias("usrs"), F.sum("item").alias("items"),
        F.sum("rating").alias("ratings"),
    )


def same_rating_rows(spark, sf_dir):
    """Whether ratings hold the same rows after a round trip through lines, and after one is lost."""
    ratings = I.ratings(spark, sf_dir)
    lines = ratings.select(F.concat_ws("::", "usr", "item", "rating").alias("value"))
    back = S.parse_ratings(lines).filter(F.col("status") == S.VALID).select("item", "rating", "usr")
    first = ratings.agg(F.min(F.struct("usr", "item"))).scalar()
    less = ratings.filter(F.struct("usr", "item") != first)
    rows = [("round_trip", same_rows(ratings, back)), ("one_lost", same_rows(ratings, less))]
    return spark.createDataFrame(rows, "kind string, same boolean")


def item_lines_parse(spark, sf_dir):
    lines = I.items(spark, sf_dir).select(
        F.concat_ws("::", "item", "title", F.lit("tools|parts")).alias("value")
    )
    return S.parse_items(lines).select("item", "title", "status")


def item_ratings(spark, sf_dir):
    """Every item's ratings, equal ones counted."""
    return counted_members(I.ratings(spark, sf_dir), "item", "rating")


def item_averages(spark, sf_dir):
    means = R.item_averages(I.ratings(spark, sf_dir))
    return means.select("item", "n", F.round("mean_rating", 9).alias("mean_rating"))


def named_item_averages(spark, sf_dir):
    named = R.named_averages(I.ratings(spark, sf_dir), I.items(spark, sf_dir))
    return named.select(F.round("mean_rating", 9).alias("mean_rating"), "title", "n")


def well_rated_items(spark, sf_dir):
    named = R.named_averages(I.ratings(spark, sf_dir), I.items(spark, sf_dir))
    best = R.well_rated(named, SUPPORT)
    return best.select(F.round("mean_rating", 9).alias("mean_rating"), "title", "n")


def sort_composite(spark, sf_dir):
    """The first twenty items by the composite text key, greatest first."""
    named = R.named_averages(I.ratings(spark, sf_dir), I.items(spark, sf_dir))
    return R.well_rated(named, SUPPORT, 20).select("sort_key")


def first_items(spark, sf_dir):
    """Three least items with their rating count and mean."""
    means = R.item_averages(I.ratings(spark, sf_dir)).orderBy("item").limit(3)
    return means.select("item", "n", F.round("mean_rating", 9).alias("mean_rating"))


def _parts(spark, sf_dir):
    """The three parts, written once: every error measure goes over them again."""
    return settle(key_split(I.ratings(spark, sf_dir), ["usr", "item"], SHARES))


def _part(parts, name):
    return parts.filter(F.col("split") == name).drop("split")


def hash_split(spark, sf_dir):
    return key_split(I.ratings(spark, sf_dir), ["usr", "item"], SHARES).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("ratings")
    )


def rating_rmse(spark, sf_dir):
    """Error on the test part of predicting each item's mean training rating."""
    parts = _parts(spark, sf_dir)
    means = R.item_averages(_part(parts, "train")).select(
        "item", F.col("mean_rating").alias("prediction")
    )
    test = _part(parts, "test")
    predicted = spread_join(test.select("usr", "item"), means, ["item"], ["usr"])
    error = R.prediction_rmse(predicted, test)
    return error.select("n", F.round("rmse", 9).alias("rmse"))


def mean_baseline_rmse(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    base = R.mean_baseline(_part(parts, "train"), _part(parts, "test"))
    return base.select(
        F.round("train_mean", 9).alias("train_mean"), F.round("rmse", 9).alias("rmse")
    )


def _with_own(spark, sf_dir):
    return I.ratings(spark, sf_dir).unionByName(I.own_ratings(spark, sf_dir))


def union_ratings(spark, sf_dir):
    """Rows per user after adding the new user's ratings, repeats kept."""
    return _with_own(spark, sf_dir).groupBy("usr").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("ratings")
    )


def unrated_items(spark, sf_dir):
    own = I.own_ratings(spark, sf_dir)
    return R.unrated_items(I.items(spark, sf_dir), own, F.lit(I.NEW_USER))


def als_rank_grid(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    grid, _ = R.rank_grid(_part(parts, "train"), _part(parts, "validation"))
    return grid


def als_grid_test(spark, sf_dir):
    """Test error of the model that the validation part chooses, beside the mean's."""
    parts = _parts(spark, sf_dir)
    _, model = R.rank_grid(_part(parts, "train"), _part(parts, "validation"))
    test = _part(parts, "test")
    error = R.model_rmse(model, test).first()
    base = R.mean_baseline(_part(parts, "train"), test)
    return base.select(F.lit(error["n"]).alias("n"), F.col("rmse").alias("baseline_rmse"), F.lit(error["rmse"]).alias("model_rmse"))


def als_coverage(spark, sf_dir):
    """Validation and test rows that a model of the training part predicts, and those it can't."""
    parts = _parts(spark, sf_dir)
    model = R.fit_als(_part(parts, "train"), rank=4, iterations=1)
    asked = parts.filter("split <> 'train'")
    known = R.predict(model, asked).distinct()
    joined = asked.join(known, ["usr", "item"], "left")
    return joined.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("predicted"))


def supported_candidates(spark, sf_dir):
    """The new user's twenty candidates with the most ratings, of those above the support."""
    own = I.own_ratings(spark, sf_dir)
    candidates = R.unrated_items(I.items(spark, sf_dir), own, F.lit(I.NEW_USER))
    kept = R.supported(candidates, I.ratings(spark, sf_dir), SUPPORT)
    return kept.orderBy(F.desc("n"), "item").limit(20)


def als_recommend(spark, sf_dir):
    """Twenty best unrated items for the new user after retraining with their ratings."""
    own = I.own_ratings(spark, sf_dir)
    train = _part(_parts(spark, sf_dir), "train").unionByName(own)
    model = R.fit_als(train, rank=8)
    candidates = R.unrated_items(I.items(spark, sf_dir), own, F.lit(I.NEW_USER))
    return R.recommend(model, candidates, I.ratings(spark, sf_dir), SUPPORT, 20)


QUERIES = {
    f.__name__: f
    for f in (
        rating_lines_parse, item_lines_parse, item_ratings, item_averages, named_item_averages,
        well_rated_items, sort_composite, first_items, hash_split, rating_rmse,
        mean_baseline_rmse, union_ratings, unrated_items, gzip_rating_lines, same_rating_rows,
        supported_candidates, als_coverage, als_rank_grid, als_grid_test, als_recommend,
    )
}
