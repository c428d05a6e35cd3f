"""Click rows that are counted before their features are hashed."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.hashing import md5_bucket
from millrace.operators import classify as C, features as E
from millrace.plans import clicks, inputs as I

SF = "/root/testdata/sf0.001"
KIND = "row_id long, label double, feats array<struct<idx:int,cat:string>>"


def test_counted_rows_stand_for_all_they_count(spark):
    rows = spark.createDataFrame(
        [(i, float(i % 3 == 0), [(0, "ab"[i % 2]), (1, "xyz"[i // 4 % 3])]) for i in range(48)], KIND
    ).withColumn("split", F.when(F.col("row_id") < 36, "train").otherwise("test"))
    counted = E.counted_rows(rows, "split")
    assert counted.count() < 24 and counted.agg(F.sum("n")).first()[0] == 48
    settings = [(1.0, 1e-3), (10.0, 1e-6)]
    grids, bases = [], []
    for parts in (rows, counted):
        train, test = (E.hashed(parts.filter(F.col("split") == name), 64) for name in ("train", "test"))
        models = C.descend(train, settings, 20)
        scored = C.with_raw_score(test, models[:1])
        grids.append([*C.model_log_losses(test, models), scored.agg(C.mean_log_loss(scored)).first()[0]])
        bases.append([tuple(r) for r in C.baseline_log_loss(parts).orderBy("split").collect()])
    assert grids[1] == pytest.approx(grids[0], rel=1e-12)
    for (split, n, loss), want in zip(bases[1], bases[0], strict=True):
        assert (split, n) == want[:2] and loss == pytest.approx(want[2], rel=1e-12)


def test_logistic_grid_hashes_equal_rows_once(spark, monkeypatch):
    given, hashed = [], E.hashed

    def count(rows, buckets):
        given.append((rows.count(), rows.agg(F.sum("n")).first()[0], rows.select("label", "feats").distinct().count()))
        return hashed(rows, buckets)

    monkeypatch.setattr(clicks.E, "hashed", count)
    clicks.logistic_grid_test(spark, SF, 2)
    assert len(given) == 3 and all(rows == unlike <= n for rows, n, unlike in given)
    assert sum(n for _, n, _ in given) == I.click_rows(spark, SF).count()


@pytest.mark.parametrize("buckets", [1, 7, 2**15, 10**9 + 7])
def test_features_hash_as_their_texts_do(spark, buckets):
    rows = spark.createDataFrame([
        (1, 1.0, [(0, "a"), (0, "a"), (1, "b"), (2, None), (3, None)]), (2, 0.0, []), (3, None, None),
        (4, 1.0, [(None, "x"), (1, ""), (1, "é")]), (5, 0.0, [(12, "a"), (2, "a1"), (1, "a"), (7, "zz")])], KIND)
    names = rows.select("row_id", F.inline("feats")).select("row_id", F.concat("cat", F.col("idx").cast("string")).alias("name"))
    want = {}
    for r in names.distinct().dropna().select("row_id", md5_bucket(F.col("name"), buckets).alias("place")).collect():
        places = want.setdefault(r["row_id"], {})
        places[r["place"]] = places.get(r["place"], 0.0) + 1.0
    got = {r["row_id"]: r for r in E.hashed(rows, buckets).collect()}
    for key, places in want.items():
        known = [(i, v) for i, v in zip(got[key]["indices"], got[key]["values"], strict=True) if i is not None]
        assert known == sorted(places.items())
    assert got[2]["indices"] == [] and got[3]["indices"] is None and got[3]["values"] is None
    assert got[1]["indices"][-1] is None and got[1]["values"][-1] == 0.0
