import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import classify as C
from millrace.operators import features as E
from millrace.operators import ratings as R
from millrace.operators import similarity as M
from millrace.operators import tokens as K
from millrace.operators.joins import hot_keys, spread_join
from millrace.operators.ordering import (
    bottom_sample, key_split, running_totals, same_rows, top_rows, with_ordinal, with_share,
)
from millrace.session import settle

ANIMALS = [
    ("r1", 1.0, [(0, "mouse"), (1, "black")]),
    ("r2", 0.0, [(0, "cat"), (1, "tabby"), (2, "mouse")]),
    ("r3", 1.0, [(0, "bear"), (1, "black"), (2, "salmon")]),
]
FEATS = "row_id string, label double, feats array<struct<idx:int,cat:string>>"

# The literal inputs and expected results below are those to be matched


# ------------------------------------------------------------- joins and ordering

def test_spread_join_splits_a_hot_key(spark):
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    dim = spark.range(-1, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        assert same_rows(spread_join(fact, dim, ["k"], ["id"], how=how, pieces=16),
                         fact.join(dim, "k", how))
    sizes = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(sizes, ["k"], 16).collect()
    assert [r["k"] for r in hot] == [-1] and hot[0]["_spread"] >= 5


def test_ordinals(spark):
    rows = [(random.Random(i).randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = with_ordinal(df, ["a", "b"], partitions=6).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(2000))
    assert [(r["a"], r["b"]) for r in got] == sorted(rows)
    assert with_ordinal(df.filter("a < 0"), ["a", "b"]).count() == 0


def test_running_totals_with_ties(spark):
    rows = [(i % 3, i, i % 2) for i in range(900)]  # a third of the rows share one score
    df = spark.createDataFrame(rows, "s int, i int, v int").repartition(5)
    got = running_totals(df, [F.desc("s"), F.asc("i")], {"run": F.col("v"), "n": F.lit(1)}).collect()
    total = 0
    want = {}
    for n, (s, i, v) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1):
        total += v
        want[i] = (total, n)
    assert {r["i"]: (r["run"], r["n"]) for r in got} == want


def test_split_parts_make_the_whole(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 7)
    parts = key_split(df, ["id"], {"train": 6, "validation": 2, "test": 2})
    moved = key_split(df.repartition(9), ["id"], {"train": 6, "validation": 2, "test": 2})
    assert same_rows(parts, moved) and same_rows(parts.drop("split"), df)
    counts = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert abs(counts["train"] - 3000) < 150 and abs(counts["test"] - 1000) < 120


def test_top_rows_and_share(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, n bigint")
    assert [r["k"] for r in top_rows(df, "n", ["k"], 2).collect()] == ["a", "b"]
    assert {r["k"]: r["share"] for r in with_share(df, "n").collect()} == {"a": 0.4, "b": 0.4, "c": 0.2}


# ------------------------------------------------------------- words and weights

def test_word_count(spark):
    words = spark.createDataFrame([(w,) for w in ["cat", "elephant", "rat", "rat", "cat"]], "word string")
    counts = K.word_counts(words)
    assert {r["word"]: r["n"] for r in counts.collect()} == {"cat": 2, "elephant": 1, "rat": 2}
    mean = counts.agg(F.round(F.sum("n") / F.count(F.lit(1)), 2)).first()[0]
    assert mean == 1.67
    pairs = words.select("word", F.lit(1).alias("one"))
    grouped = {(r["word"], r["one"]): r["n"] for r in K.counted_members(pairs, "word", "one").collect()}
    assert grouped == {("cat", 1): 2, ("elephant", 1): 1, ("rat", 1): 2}


def records(spark, rows):
    return spark.createDataFrame(rows, "id int, side string, text string")


def test_stop_words_tf_and_norm(spark):
    stop = spark.createDataFrame([("why",), ("a",), ("the",)], "word string")
    bags = K.token_bags(records(spark, [(1, "a", "Why a the?"), (2, "a", "one_ one_ two!")]), stop)
    assert {r["id"]: r["tokens"] for r in bags.collect()} == {1: [], 2: ["one_", "one_", "two"]}
    rates = {r["token"]: r["tf"] for r in K.term_frequencies(bags, "id").collect()}
    assert rates == {"one_": 2 / 3, "two": 1 / 3}
    weights = spark.createDataFrame([(1, "foo", 2.0), (1, "bar", 3.0), (1, "baz", 5.0)],
                                    "id int, token string, weight double")
    assert K.weight_norms(weights, "id").first()["norm"] == pytest.approx(6.16441400297)


def test_inverse_ratio_counts_records_without_log(spark):
    bags = K.token_bags(records(spark, [(1, "a", "x x y"), (2, "g", "x"), (3, "g", "")]))
    ratios = {r["token"]: r["idf"] for r in K.inverse_ratios(bags).collect()}
    assert ratios == {"x": 1.5, "y": 3.0}
    assert K.token_total(bags).first()["n_tokens"] == 4


def test_equal_width_histogram(spark):
    import numpy as np

    values = [1.0, 1.5, 2.0, 9.9, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["bin"]: r["n"] for r in K.equal_width_histogram(df, "v", 9).collect()}
    counts, _ = np.histogram(values, 9)
    assert got == {i: int(n) for i, n in enumerate(counts) if n}


# ------------------------------------------------------------- similarity

def brute_force(rows):
    """Cosine of every (a, g) record pair that shares a token."""
    bags = {i: (side, text.split()) for i, side, text in rows}
    df = Counter(t for _, toks in bags.values() for t in set(toks))
    w = {i: {t: c / len(toks) * len(bags) / df[t] for t, c in Counter(toks).items()}
         for i, (_, toks) in bags.items() if toks}
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in w.items()}
    out = {}
    for a in w:
        for g in w:
            if bags[a][0] == "a" and bags[g][0] == "g":
                shared = w[a].keys() & w[g].keys()
                if shared:
                    out[a, g] = sum(w[a][t] * w[g][t] for t in shared) / norm[a] / norm[g]
    return out


@pytest.fixture(scope="module")
def skewed():
    """A third of the records are copies of one text, one token is everywhere and some
    records hold nothing rare."""
    rng = random.Random(3)
    vocab = [f"t{int(rng.paretovariate(0.8))}" for _ in range(400)]
    rows = []
    for i in range(150):
        side = "a" if rng.random() < 0.5 else "g"
        if i % 3 == 0:
            text = "everywhere copy of one text"
        elif i % 3 == 1:
            text = " ".join(["everywhere"] + rng.choices(vocab, k=rng.randrange(1, 12)))
        else:
            text = " ".join(rng.choices(vocab, k=rng.randrange(0, 8)))
        rows.append((i, side, text))
    return rows


@pytest.fixture(scope="module")
def catalogues(spark, skewed):
    return M.build_catalogues(K.token_bags(records(spark, skewed)))


@pytest.mark.parametrize("least", [0.001, 0.01, 0.1, 0.5, 0.95])
def test_similar_pairs_against_brute_force(spark, skewed, catalogues, least):
    bag = {(r["side"], r["id"]): r["bag"] for r in catalogues.members.collect()}
    want, sizes = {}, defaultdict(int)
    for (a, g), cosine in brute_force(skewed).items():
        if round(cosine, 9) >= least:
            pair = bag["a", a], bag["g", g]
            want[pair] = cosine
            sizes[pair] += 1
    got = M.similar_pairs(catalogues, least).collect()
    assert {(r["bag_a"], r["bag_g"]): r["n_a"] * r["n_g"] for r in got} == dict(sizes)
    for r in got:
        assert r["cosine"] == pytest.approx(want[r["bag_a"], r["bag_g"]], abs=1e-9)


@pytest.mark.parametrize("cut", [0.0, 0.1, 0.4])
def test_products_of_kept_tokens_bound_the_cosine(skewed, catalogues, cut):
    """Without a cut they are the cosines of all pairs that share a token."""
    bag = {(r["side"], r["id"]): r["bag"] for r in catalogues.members.collect()}
    sims = {(bag["a", a], bag["g", g]): c for (a, g), c in brute_force(skewed).items()}
    found = {(r["bag_a"], r["bag_g"]): r["cosine"] for r in M.bounded_pairs(catalogues, cut).collect()}
    assert found.keys() <= sims.keys() and (cut or found.keys() == sims.keys())
    for pair, c in sims.items():
        assert found.get(pair, 0.0) - 1e-9 <= c <= found.get(pair, 0.0) + cut + 1e-9
    with pytest.raises(ValueError):
        M.similar_pairs(catalogues, 0.0)


def test_evaluation_against_brute_force(spark, skewed, catalogues):
    sims = brute_force(skewed)
    side = {i: s for i, s, _ in skewed}
    full = [i for i, _, text in skewed if text]
    everything = [(a, g) for a in full for g in full if side[a] == "a" and side[g] == "g"]
    gold = sorted(sims, key=lambda p: (-sims[p], p))[:40]
    gold += [p for p in everything if p not in sims][:5] + [(9999, 9998)]  # missing ones score 0
    table = spark.createDataFrame(gold, "a_id int, g_id int")

    scored = {(r["a_id"], r["g_id"]): r for r in M.gold_similarities(catalogues, table).collect()}
    assert len(scored) == len(gold)
    for pair in gold:
        assert scored[pair]["cosine"] == pytest.approx(sims.get(pair, 0.0), abs=1e-9)
    assert not scored[9999, 9998]["known"]

    means = M.duplicate_means(catalogues, table).first()
    known = [p for p in gold if p in set(everything)]
    others = [sims.get(p, 0.0) for p in everything if p not in set(gold)]
    assert means["n_dups"] == len(known)
    assert means["mean_dups"] == pytest.approx(sum(sims.get(p, 0) for p in known) / len(known))
    assert means["mean_others"] == pytest.approx(sum(others) / len(others))

    def place(c):
        return math.floor(round(c * 100, 7))

    all_bins = Counter(place(sims.get(p, 0.0)) for p in everything)
    gold_bins = Counter(place(sims.get(p, 0.0)) for p in gold)
    histogram = M.similarity_histogram(catalogues, table)
    assert {r["bin"]: (r["pairs"], r["golds"]) for r in histogram.collect()} == {
        b: (all_bins[b], gold_bins[b]) for b in range(101)}

    for r in M.threshold_sweep(histogram).collect():
        k = round(r["threshold"] * 100)
        fp = sum(all_bins[b] - gold_bins[b] for b in range(k, 101))
        tp = sum(gold_bins[b] for b in range(k, 101))
        assert (r["fp"], r["tp"], r["fn"]) == (fp, tp, len(gold) - tp)
        assert r["precision"] == (None if tp + fp == 0 else pytest.approx(tp / (tp + fp)))
        assert r["recall"] == pytest.approx(tp / len(gold))


# ------------------------------------------------------------- ratings

def ratings(spark, rows, value="rating"):
    return spark.createDataFrame([(u, i, float(v)) for u, i, v in rows],
                                 f"usr int, item int, {value} double")


ACTUAL = [(1, 2, 3), (1, 3, 5), (2, 1, 5), (2, 2, 1)]


@pytest.mark.parametrize("predicted, want", [
    ([(1, 1, 5), (1, 2, 3), (1, 3, 4), (2, 1, 3), (2, 2, 2), (2, 3, 4)], 1.22474487139),
    ([(2, 2, 5), (1, 2, 5)], 3.16227766017),
    (ACTUAL, 0.0),
])
def test_prediction_rmse(spark, predicted, want):
    got = R.prediction_rmse(ratings(spark, predicted, "prediction"), ratings(spark, ACTUAL)).first()
    assert got["rmse"] == pytest.approx(want, abs=1e-9)


def test_prediction_rmse_with_repeated_keys(spark):
    p, a = [(1, 1, 5), (1, 1, 2), (1, 2, 3)], [(1, 1, 4), (1, 1, 1), (1, 1, 1), (1, 2, 2)]
    want = [(x[2] - y[2]) ** 2 for x in p for y in a if x[:2] == y[:2]]
    got = R.prediction_rmse(ratings(spark, p, "prediction"), ratings(spark, a)).first()
    assert got["n"] == len(want)
    assert got["rmse"] == pytest.approx(math.sqrt(sum(want) / len(want)))


def test_item_averages(spark):
    rows = [(u, 1, v) for u, v in enumerate((1, 2, 3, 4))] + [(u, 110, u) for u in range(20)]
    got = {r["item"]: (r["n"], r["mean_rating"]) for r in R.item_averages(ratings(spark, rows)).collect()}
    assert got == {1: (4, 2.5), 110: (20, 9.5)}


def test_als_beats_the_mean_and_recommends_unrated_items(spark):
    rng = random.Random(1)
    taste = {u: rng.choice([-1, 1]) for u in range(60)}
    kind = {i: rng.choice([-1, 1]) for i in range(40)}
    rows = [(u, i, 3 + 1.5 * taste[u] * kind[i] + rng.uniform(-0.2, 0.2))
            for u in range(60) for i in range(40) if rng.random() < 0.6]
    everything = ratings(spark, rows)
    parts = key_split(everything, ["usr", "item"], {"train": 6, "validation": 2, "test": 2})
    train = parts.filter("split = 'train'").drop("split")
    held = parts.filter("split = 'validation'").drop("split")
    grid, model = R.rank_grid(train, held, (2, 4))
    best = grid.filter("best").first()
    assert best["rmse"] == grid.agg(F.min("rmse")).first()[0]
    assert best["rmse"] < R.mean_baseline(train, held).first()["rmse"]

    own = ratings(spark, [(-1, i, 4.5 if kind[i] == 1 else 1.5) for i in range(10)] + [(-1, 3, 4.0)])
    both = train.unionByName(own)
    assert both.count() - train.count() == 11  # the item rated twice stays twice
    items = spark.range(40).select(F.col("id").cast("int").alias("item"))
    wanted = R.unrated_items(items, own, F.lit(-1))
    assert wanted.count() == 30
    best_items = R.recommend(R.fit_als(both, 4), wanted, everything, 20, 5).collect()
    assert all(r["item"] >= 10 and r["n"] > 20 for r in best_items)
    assert all(kind[r["item"]] == 1 for r in best_items)


# ------------------------------------------------------------- features

def test_dictionary_and_one_hot(spark):
    rows = spark.createDataFrame(ANIMALS, FEATS)
    dictionary = E.feature_dictionary(rows)
    ordinals = {(r["idx"], r["cat"]): r["ordinal"] for r in dictionary.collect()}
    assert ordinals == {(0, "bear"): 0, (0, "cat"): 1, (0, "mouse"): 2, (1, "black"): 3,
                        (1, "tabby"): 4, (2, "mouse"): 5, (2, "salmon"): 6}
    encoded = {r["row_id"]: (r["indices"], r["values"]) for r in E.one_hot(rows, dictionary, strict=True).collect()}
    assert encoded == {"r1": ([2, 3], [1, 1]), "r2": ([1, 4, 5], [1, 1, 1]), "r3": ([0, 3, 6], [1, 1, 1])}
    assert {r["idx"]: r["n_categories"] for r in E.categories_per_feature(rows).collect()} == {0: 3, 1: 2, 2: 2}
    hot = E.one_hot(rows, dictionary)
    assert E.nonzeros(hot).first()["n_nonzero"] == 8
    assert E.sparsity(hot, F.lit(7)).first()["sparsity"] == pytest.approx(8 / 3 / 7)
    assert E.first_rows_total(hot, F.size("indices"), 2).first()["total"] == 5


@pytest.mark.parametrize("held", [E.HELD_FEATURES, 0])
def test_rows_that_share_an_id_keep_their_own_features(spark, held, monkeypatch):
    """With the dictionary in every task and with dealt uses."""
    monkeypatch.setattr(E, "HELD_FEATURES", held)
    rows = settle(spark.createDataFrame(
        [("r", 0.0, [(0, "a"), (1, "x")]), ("r", 1.0, [(0, "b")]), ("s", 1.0, []), ("t", 0.0, [(0, "a")])] + [("u", 0.0, [(0, "a"), (1, "y")])] * 9,
        FEATS).repartition(3))
    dictionary = E.feature_dictionary(rows.filter("row_id <> 't'"))
    got = sorted((r["row_id"], r["label"], r["indices"], r["values"]) for r in E.one_hot(rows, dictionary).collect())
    assert got == sorted([("r", 0.0, [0, 2], [1.0, 1.0]), ("r", 1.0, [1], [1.0]), ("s", 1.0, [], []), ("t", 0.0, [0], [1.0])]
                         + [("u", 0.0, [0, 3], [1.0, 1.0])] * 9)
    weights = dictionary.select("ordinal", (F.col("ordinal") + 1.0).alias("weight"))
    scores = sorted((r["row_id"], r["raw_score"]) for r in E.weighted_scores(rows, dictionary, weights, -1.0).collect())
    assert scores == sorted([("r", 3.0), ("r", 1.0), ("s", -1.0), ("t", 0.0)] + [("u", 4.0)] * 9)
    unseen = E.unseen_features(rows, E.feature_dictionary(rows.filter("label = 1"))).groupBy("idx", "cat").count().collect()
    assert {(r["idx"], r["cat"]): r["count"] for r in unseen} == {(0, "a"): 11, (1, "x"): 1, (1, "y"): 9}


def test_unseen_categories(spark):
    rows = spark.createDataFrame(ANIMALS, FEATS)
    dictionary = E.feature_dictionary(rows)
    new = spark.createDataFrame([("n", 0.0, [(0, "dog"), (1, "black")]), ("m", 0.0, [(0, "dog")])], FEATS)
    got = {r["row_id"]: r["indices"] for r in E.one_hot(new, dictionary).collect()}
    assert got == {"n": [3], "m": []}
    with pytest.raises(KeyError):
        E.one_hot(new, dictionary, strict=True)


def test_hashing(spark):
    rows = spark.createDataFrame(ANIMALS, FEATS)

    def places(buckets):
        return {r["row_id"]: dict(zip(r["indices"], r["values"])) for r in E.hashed(rows, buckets).collect()}

    assert places(4)["r1"] == {2: 1.0, 3: 1.0}
    assert places(100)["r3"] == {72: 1.0, 5: 1.0, 14: 1.0}
    # equal category text + position collapses, different text in one place adds up
    twins = spark.createDataFrame([("t", 0.0, [(1, "1"), (11, "")]), ("u", 0.0, [(0, "a"), (1, "b"), (2, "c")])], FEATS)
    one_place = {r["row_id"]: r["values"] for r in E.hashed(twins, 1).collect()}
    assert one_place == {"t": [1.0], "u": [3.0]}


def test_count_buckets_leave_out_large_counts(spark):
    counts = spark.createDataFrame([(1,), (2,), (3,), (4,), (1024,), (1025,)], "n bigint")
    got = {r["bucket"]: r["n_features"] for r in E.count_bucket_histogram(counts).collect()}
    assert got == {1: 1, 2: 1, 4: 2, 1024: 1}


def test_weighted_scores(spark):
    rows = spark.createDataFrame(ANIMALS, FEATS)
    dictionary = E.feature_dictionary(rows)
    weights = dictionary.select("ordinal", (F.col("ordinal") * 1.0).alias("weight"))
    got = {r["row_id"]: r["raw_score"] for r in E.weighted_scores(rows, dictionary, weights, -1.0).collect()}
    assert got == {"r1": 4.0, "r2": 9.0, "r3": 8.0}


# ------------------------------------------------------------- order, samples, digests

def test_running_totals(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(6), rng.choice([None, *range(5)]), rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, s int, n int, x double").repartition(7)
    order = [F.desc("s"), F.asc("id")]
    got = {r["id"]: (r["total"], r["sum_x"]) for r in running_totals(df, order, {"total": F.col("n"), "sum_x": F.col("x")}).collect()}
    total, x = 0, 0.0
    for i, _, n, v in sorted(rows, key=lambda r: (-r[1], r[0])):
        total, x = total + (n or 0), x + v
        assert got[i] == (total, pytest.approx(x))
    plan = running_totals(df, order, {"total": F.col("n")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # of the blocks' totals, a row a block
    assert running_totals(df.limit(0), order, {"total": F.col("n")}).count() == 0


def test_area_under_the_curve(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(20) / 20, float(rng.random() < 0.4)) for _ in range(300)] + [(None, 1.0), (0.5, None)]
    df = spark.createDataFrame(rows, "s double, y double")
    known = [(s, y) for s, y in rows if s is not None and y is not None]
    won = [1.0 if a > b else 0.5 if a == b else 0.0 for a, y in known if y == 1 for b, z in known if z == 0]
    got = C.area_under_curve(df, "s", "y").first()
    assert (got["positives"], got["negatives"], got["auc"]) == (
        sum(y == 1 for _, y in known), sum(y == 0 for _, y in known), pytest.approx(sum(won) / len(won)))
    assert C.area_under_curve(df.filter("y = 1"), "s", "y").first()["auc"] is None
    assert C.area_under_curve(df.limit(0), "s", "y").first()["positives"] == 0


def test_a_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("int").alias("a"), (F.col("id") % 7).alias("b"))
    found = [sorted(map(tuple, bottom_sample(df.repartition(n), ["a", "b"], 20).collect())) for n in (1, 3, 11)]
    assert found[0] == found[1] == found[2] and len(set(found[0])) == 20
    assert max(a for a, _ in found[0]) > 500  # not a prefix
    assert bottom_sample(df.limit(5), ["a"], 20).count() == 5


def test_digests_tell_tables_apart(spark):
    kind = "a int, b string, c array<double>"
    rows = [(1, "x", [1.0]), (1, "x", [1.0]), (2, None, None), (None, "", [])]
    table = spark.createDataFrame(rows, kind)
    assert same_rows(table, table.repartition(3).select("c", "a", "b"))
    others = [rows[1:], [*rows, rows[0]], [(1, "x", [1.0]), (2, None, None), (2, None, None), (None, "", [])],
              [(1, "x", [1.0]), (1, "x", [1.0]), (2, "", None), (None, None, [])], []]
    for other in others:
        assert not same_rows(table, spark.createDataFrame(other, kind))
    assert not same_rows(table, table.drop("c"))
    empty = spark.createDataFrame([], kind)
    assert same_rows(empty, empty)
