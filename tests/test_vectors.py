"""Vectors of numbered tokens, their products and the binned products of blocks."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import features as E
from millrace.operators import tokens as K
from millrace.operators import vectors as V


@pytest.fixture(scope="module")
def bags():
    rng = random.Random(11)
    vocab = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)] + ["höhe", "x" * 90]
    return {i: ["all"] * (i % 3) + rng.choices(vocab, k=rng.randrange(1, 30)) for i in range(120)}


def unit(bags):
    df = Counter(t for toks in bags.values() for t in set(toks))
    out = {}
    for i, toks in bags.items():
        w = {t: c * len(bags) / df[t] for t, c in Counter(toks).items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out[i] = {t: x / norm for t, x in w.items()}
    return out


def built(spark, bags):
    rows = spark.createDataFrame(list(bags.items()), "id long, tokens array<string>").repartition(3)
    table = V.token_table(K.inverse_ratios(rows))
    return table, V.unit_vectors(V.settle(V.counted_tokens(rows, table)), table, "id")


@pytest.mark.parametrize("held", [1 << 17, 25, 0])
def test_unit_vectors_with_few_or_no_held_tokens(spark, bags, monkeypatch, held):
    monkeypatch.setattr(V, "HELD_TOKENS", held)
    table, vectors = built(spark, bags)
    names = {r["code"]: r["token"] for r in table.terms.collect()}
    assert sorted(names) == list(range(len(names)))
    want = unit(bags)
    rows = vectors.collect()
    assert len(rows) == len(bags)
    for r in rows:
        assert r["codes"] == sorted(r["codes"])
        assert {names[c]: u for c, u in zip(r["codes"], r["units"], strict=True)} == pytest.approx(want[r["id"]])


@pytest.mark.parametrize("tile, dense", [(1 << 11, 1000), (7, 0), (16, 40)])
def test_binned_products_of_blocks(spark, bags, monkeypatch, tile, dense):
    """All tiles, dense and sparse parts together count each pair once, copies multiplied."""
    monkeypatch.setattr(V, "TILE", tile)
    monkeypatch.setattr(V, "DENSE", dense)
    monkeypatch.setattr(V, "BLOCK_POSTINGS", 300)
    _, vectors = built(spark, bags)
    counted = vectors.withColumn("n", F.col("id") % 4 + 1)
    got = V.cosine_bins(counted.filter("id < 70"), counted.filter("id >= 50"), 100).collect()
    units, want = unit(bags), Counter()
    for a in range(70):
        for g in range(50, 120):
            c = sum(u * units[g].get(t, 0.0) for t, u in units[a].items())
            want[math.floor(round(c * 100, 7))] += (a % 4 + 1) * (g % 4 + 1)
    assert {r["bin"]: r["pairs"] for r in got} == {b: n for b, n in want.items() if b > 0}


def binned(bags, lefts, rights, bins):
    units, want = unit(bags), Counter()
    for a in lefts:
        for g in rights:
            c = sum(u * units[g].get(t, 0.0) for t, u in units[a].items())
            want[math.floor(round(c * bins, 7))] += (a % 4 + 1) * (g % 4 + 1)
    return {b: n for b, n in want.items() if b > 0}


@pytest.mark.parametrize("bins, dropped, filled, cells", [
    (100, 0, 1 << 30, 0), (100, 0.6, 1 << 30, 1 << 30), (5, 0.99, 0, 0), (5, 0.99, 1 << 30, 0), (5, 0.99, 1 << 30, 1 << 30)])
def test_bins_of_pairs_with_dropped_tokens(spark, bags, monkeypatch, bins, dropped, filled, cells):
    """Whole tiles or single pairs, and few or many pairs left open, give the same bins."""
    for name, value in (("FILLED", filled), ("CELLS", cells), ("DROPPED", dropped), ("SLICE", 50)):
        monkeypatch.setattr(V, name, value)
    _, vectors = built(spark, bags)
    counted = vectors.withColumn("n", F.col("id") % 4 + 1)
    got = V.cosine_bins(counted.filter("id < 70"), counted.filter("id >= 50"), bins, "id").collect()
    assert {r["bin"]: r["pairs"] for r in got} == binned(bags, range(70), range(50, 120), bins)


def test_pairs_that_share_only_common_tokens_are_not_multiplied(spark, monkeypatch):
    """No tile of all pairs is filled where few pairs share a rare token."""
    bags = {i: ["all", f"some{i % 2}", f"r{i // 3}", f"r{i // 3}x{i % 2}", f"own{i}"] for i in range(90)}
    monkeypatch.setattr(V, "TILE", 0)  # a tile of no rows can't be made
    _, vectors = built(spark, bags)
    counted = vectors.withColumn("n", F.col("id") % 4 + 1)
    got = V.cosine_bins(counted.filter("id < 60"), counted.filter("id >= 30"), 10).collect()
    assert {r["bin"]: r["pairs"] for r in got} == binned(bags, range(60), range(30, 90), 10)


@pytest.mark.parametrize("held", [1 << 17, 25, 0])
def test_token_weights_with_few_held_tokens_and_repeated_keys(spark, bags, monkeypatch, held):
    """Rows of one key and one length are one record; postings aren't shuffled for them."""
    monkeypatch.setattr(V, "HELD_TOKENS", held)
    twice = [*bags.items(), (3, bags[3]), (4, bags[4] + ["once"]), (500, [])]
    rows = spark.createDataFrame(twice, "id long, tokens array<string>")
    df = Counter(t for _, toks in twice for t in set(toks))
    tf, weights = Counter(), Counter()
    for i, toks in twice:
        for t, c in Counter(toks).items():
            tf[i, len(toks), t] += c / len(toks)
            weights[i, len(toks), t] += c / len(toks) * len(twice) / df[t]

    def spelt(rows, value):
        return sorted((r["id"], r["token"], round(r[value], 9)) for r in rows)

    assert spelt(K.term_frequencies(rows, "id").collect(), "tf") == sorted((i, t, round(x, 9)) for (i, _, t), x in tf.items())
    found = K.tfidf(rows, "id")
    assert spelt(found.collect(), "weight") == sorted((i, t, round(x, 9)) for (i, _, t), x in weights.items())
    names = {r["id"]: r["norm"] for r in K.weight_norms(found, "id").collect()}
    assert names[5] == pytest.approx(math.sqrt(sum(x * x for (i, _, _), x in weights.items() if i == 5)))


def test_features_looked_up_within_the_row_and_by_the_join_agree(spark, monkeypatch):
    """Repeats stay, unknown and NULL categories drop out, rows without features keep an empty list."""
    feats = [[(0, "a"), (1, "b"), (0, "a")], [(1, None), (2, "x"), (1, "b")], [], None, [(0, "z")]]
    rows = spark.createDataFrame([(f"r{i}", float(i % 2), f) for i, f in enumerate(feats)],
                                 "row_id string, label double, feats array<struct<idx: int, cat: string>>")
    dictionary = spark.createDataFrame([(0, "a", 3, 0), (1, None, 1, 1), (1, "b", 2, 2)], "idx int, cat string, n long, ordinal long")
    want = {"r0": [0, 0, 2], "r1": [2], "r2": [], "r3": [], "r4": []}
    held = E.one_hot(rows, dictionary)
    assert "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
    assert {r["row_id"]: r["indices"] for r in held.collect()} == want
    monkeypatch.setattr(E, "HELD_FEATURES", 0)
    assert {r["row_id"]: r["indices"] for r in E.one_hot(rows, dictionary).collect()} == want


TEXTS = ["", None, "One two  ONE\ttwo_3", "--", "Straße, ÉTÉ naïve", "end.", "\u2028a\u00a0b 漢字c", "x" * 90 + " y", "K\u212a ſ0 😀z", " . "]


def test_texts_cut_by_bytes_are_those_of_the_column_expression(spark, monkeypatch):
    monkeypatch.setattr(K, "CUT_BYTES", 12)
    rows = spark.createDataFrame(list(enumerate(TEXTS * 3)), "id long, text string").coalesce(1)
    want = {r["id"]: r["t"] for r in rows.select("id", T.tokens(F.col("text")).alias("t")).collect()}
    bags = K.token_bags(rows)
    assert {r["id"]: r["tokens"] for r in bags.collect()} == want
    stop = spark.createDataFrame([("one",), (None,), ("y",)], "word string")
    assert {r["id"]: r["tokens"] for r in K.without_words(bags, stop).collect()} == {
        i: None if t is None else [x for x in t if x not in ("one", "y")] for i, t in want.items()}
    plan = K.inverse_ratios(K.without_words(bags, stop))
    assert {r["token"]: r["n_docs"] for r in plan.collect()} == Counter(
        x for t in want.values() for x in set(t or []) if x not in ("one", "y"))
    assert {round(r["idf"] * r["n_docs"], 6) for r in plan.collect()} == {float(len(want))}


def test_steps_over_tokens_run_in_one_pass(spark):
    """Lists of tokens that lie between two steps aren't made into rows."""
    rows = spark.createDataFrame([(1, "a b a"), (2, "b")], "id long, text string")
    bags = K.without_words(K.token_bags(rows), spark.createDataFrame([("c",)], "word string"))
    counts = K.document_counts(bags)
    assert counts._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["token"]: r["n_docs"] for r in counts.collect()} == {"a": 1, "b": 2}


def test_spelling_is_the_digest_of_the_sorted_tokens(spark, bags):
    rows = spark.createDataFrame([*bags.items(), (500, [])], "id long, tokens array<string>")
    for r in V.spelt_bags(rows).collect():
        want = sorted(bags.get(r["id"], []), key=str.encode)
        assert r["tokens"] == want
        assert r["spelling"] == hashlib.md5(" ".join(want).encode()).hexdigest()
