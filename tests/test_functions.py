import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.functions import scores, text as T
from millrace.functions.hashing import md5_bucket, unit_interval

# The literal inputs and expected results below are those to be matched


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, want", [
    (" The Elephant's 4 cats. ", "the elephants 4 cats"),
    ("Hi, you!", "hi you"),
    (" No under_score!", "no underscore"),
    ("\t back\\slash stays \r", "back\\slash stays"),
])
def test_clean(spark, raw, want):
    assert one(spark, raw, T.clean) == want


@pytest.mark.parametrize("raw, want", [
    ("A quick brown fox jumps over the lazy dog.",
     ["a", "quick", "brown", "fox", "jumps", "over", "the", "lazy", "dog"]),
    (" ", []),
    ("!!!!123A/456_B/789C.123A", ["123a", "456_b", "789c", "123a"]),
    ("fox fox", ["fox", "fox"]),
    ("Église été", ["glise", "t"]),
    ("Kelvin İx", ["elvin", "x"]),  # letters whose lower case is ASCII
])
def test_tokens(spark, raw, want):
    assert one(spark, raw, T.tokens) == want


def test_words_keep_empties(spark):
    assert one(spark, "", T.words) == [""]
    assert one(spark, "a  b", T.words) == ["a", "", "b"]
    assert one(spark, "cat", T.plural) == "cats"


@pytest.mark.parametrize("value", [2.0625, 2.0875, 2.0375, 10.0, 4.3096, 0.0005, 3.9995, 1 / 3])
def test_fixed_three_rounds_like_c(spark, value):
    assert one(spark, value, T.fixed_three, "double") == "%.3f" % value


def test_composite_key_order(spark):
    first = [(1, "alpha"), (2, "alpha"), (2, "beta"), (3, "alpha"), (1, "epsilon"), (1, "delta")]
    second = [(1, "delta"), (2, "alpha"), (2, "beta"), (3, "alpha"), (1, "epsilon"), (1, "alpha")]

    def ordered(rows):
        df = spark.createDataFrame([(float(k), v) for k, v in rows], "k double, v string")
        return df.orderBy(T.rating_key(F.col("k"), F.col("v"))).collect()

    assert ordered(first) == ordered(second)
    # the key is text, so 10 sorts below 9
    ten = spark.createDataFrame([(10.0, "x"), (9.0, "x")], "k double, v string")
    assert ten.orderBy(T.rating_key(F.col("k"), F.col("v"))).first()["k"] == 10.0


def test_series_sums(spark):
    v = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    kind = "array<double>"
    assert one(spark, v, lambda c: A.fold(c, 2), kind) == [6.0, 9.0]
    assert one(spark, v, lambda c: A.fold(c, 3), kind) == [3.0, 5.0, 7.0]
    assert one(spark, v, lambda c: A.block_sums(c, 3), kind) == [3.0, 12.0]
    assert one(spark, v, lambda c: A.block_sums(c, 2), kind) == [1.0, 5.0, 9.0]


def test_rescale_and_zero_mean(spark):
    kind = "array<double>"
    assert one(spark, [1.0, 3.0], A.rescale, kind) == [-0.5, 0.5]
    assert one(spark, [-1.0, 1.0], A.rescale, kind) == [None, None]
    assert one(spark, [2.0, 4.0, 4.0, 4.0, 5.0, 5.0, 7.0, 9.0], A.array_std, kind) == 2.0


def test_interactions(spark):
    kind = "array<double>"
    assert one(spark, [2.0, 3.0], A.interactions, kind) == [2, 3, 4, 6, 6, 9]
    got = one(spark, [1.0, 2.0, 3.0], A.interactions, kind)
    assert sorted(got) == sorted([1, 2, 3, 1, 2, 3, 2, 4, 6, 3, 6, 9])


@pytest.mark.parametrize("w, y, x, want", [
    ([1, 1, 1], 2.0, [3.0, 1.0, 4.0], [18, 6, 24]),
    ([0.24, 1.2, -1.4], 3.0, [-1.4, 4.2, 2.1], [1.7304, -5.1912, -2.5956]),
])
def test_gradient(spark, w, y, x, want):
    got = one(spark, x, lambda c: A.gradient_summand(A.literal_array(w), c, F.lit(y)),
              "array<double>")
    assert got == pytest.approx(want)


@pytest.mark.parametrize("p, y, want", [
    (0.5, 1.0, 0.69314718056), (0.01, 0.0, 0.0100503358535), (0.01, 1.0, 4.60517018599),
    (0.0, 1.0, 25.3284360229), (1.0, 1.0, 1.00000008275e-11), (1.0, 0.0, 25.3284360229),
])
def test_log_loss(spark, p, y, want):
    got = one(spark, p, lambda c: scores.log_loss(c, F.lit(y)), "double")
    assert got == pytest.approx(want, rel=1e-6)


def test_probability_is_held(spark):
    assert one(spark, 50.0, scores.probability, "double") == 1 / (1 + math.exp(-20))
    assert one(spark, -50.0, scores.probability, "double") == 1 / (1 + math.exp(20))


@pytest.mark.parametrize("n, want", [(1, 1), (2, 2), (3, 4), (1024, 1024), (1025, -1)])
def test_count_bucket(spark, n, want):
    assert one(spark, n, scores.count_bucket, "bigint") == want


@pytest.mark.parametrize("text, buckets", [
    ("mouse0", 4), ("black1", 4), ("bear0", 100), ("salmon2", 100), ("x", 7), ("y", 2**15),
    ("z", 2**31 - 1),
])
def test_md5_bucket(spark, text, buckets):
    import hashlib

    want = int(hashlib.md5(text.encode()).hexdigest(), 16) % buckets
    assert one(spark, text, lambda c: md5_bucket(c, buckets)) == want


def test_unit_interval_depends_on_the_key_only(spark):
    df = spark.range(2000).select("id", unit_interval(F.col("id")).alias("u"))
    again = df.repartition(7).select("id", unit_interval(F.col("id")).alias("u"))
    assert df.exceptAll(again).isEmpty()
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < high < 1 and abs(mean - 0.5) < 0.03
