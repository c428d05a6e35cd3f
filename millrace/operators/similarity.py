"""Cosine similarity between two catalogues of token bags, and its evaluation.

Three choices keep this linear-ish in the input:

* Records with the same bag of tokens share one vector. Pairs are listed per pair of
  bags with the number of records on each side, never per pair of copies.
* Pairs at or above a similarity are found from each vector's informative tokens only,
  then scored exactly (`similar_pairs`); where only a bin of the similarity is wanted, blocks of
  vectors are multiplied and pairs counted where they arise (`similarity_histogram`).
* Sums over *all* pairs need no pairs at all: the sum of all cosines is the product of
  the two catalogues' summed unit vectors (`total_similarity`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import PIECES, spread_join
from millrace.operators.tokens import inverse_ratios
from millrace.operators.vectors import COUNTS, cosine_bins, counted_tokens, dot_products, met, postings, spelt_bags, token_table, unit_vectors
from millrace.session import settle

PAIR = ["bag_a", "bag_g", "n_a", "n_g", "a_id", "g_id"]
BINS = 101  # one per hundredth, and one for a similarity of exactly 1
NOISE = 1e-8  # more than sums of products are off by, and than a bin's rounding


@dataclass(frozen=True)
class Catalogues:
    """`members`: side, id, bag, spelling (a digest of the sorted tokens).
    `bags`: bag, spelling, n_a, n_g, a_id, g_id (records and least id per side); `bag`
    is a number, which keeps the long tables below narrow.
    `vectors`: a row a bag with n_a, n_g, a_id, g_id, `codes` (the tokens' numbers, commonest
    token first) and `units`, the weights over the vector's norm."""

    members: DataFrame
    bags: DataFrame
    vectors: DataFrame


def build_catalogues(records: DataFrame) -> Catalogues:
    """`records`: side ('a' or 'g'), id, tokens. Records without tokens have no cosine
    and are left out, though they count as records in the inverse ratios. The records' counted tokens
    are written once; a bag's vector is that of its first record: copies would scale the whole
    vector, which leaves `units` alone."""
    table = token_table(inverse_ratios(records))
    counted = settle(
        counted_tokens(spelt_bags(records), table).filter(F.size("codes") + F.size("rare") > 0)
        .select(F.monotonically_increasing_id().alias("bag"), "side", "id", "spelling", *COUNTS)
    )
    is_a, is_g = F.col("side") == "a", F.col("side") == "g"
    bags = settle(
        counted.groupBy("spelling")
        .agg(
            F.min("bag").alias("bag"),
            F.count_if(is_a).alias("n_a"),
            F.count_if(is_g).alias("n_g"),
            F.min(F.when(is_a, F.col("id"))).alias("a_id"),
            F.min(F.when(is_g, F.col("id"))).alias("g_id"),
        )
    )
    first = counted.select("bag", *COUNTS).join(bags.drop("spelling"), "bag")
    vectors = settle(unit_vectors(first, table, "bag"))
    members = spread_join(
        counted.select("side", "id", "spelling"), bags.select("spelling", "bag"), ["spelling"], ["id"],
        bags.select("spelling", (F.col("n_a") + F.col("n_g")).alias("n")),
    )
    return Catalogues(members, bags, vectors)


def _shared_token_products(kept: DataFrame) -> DataFrame:
    """(bag_a, bag_g, cosine, n_a, n_g) over the tokens in `kept`.

    The work on a token is the product of its two posting lists. A token with more than
    1/PIECES of all work (fewer than PIECES tokens, hence the broadcast) has both lists
    cut up and joined piece by piece.
    """
    lists = kept.groupBy("token").agg(
        F.count_if(F.col("n_a") > 0).alias("_la"), F.count_if(F.col("n_g") > 0).alias("_lg")
    ).filter("_la > 0 and _lg > 0")
    work = F.col("_la").cast("double") * F.col("_lg")
    total = lists.agg(F.sum(work)).scalar()
    side = F.ceil(F.sqrt(work * PIECES / total))
    hot = F.broadcast(
        lists.filter(work * PIECES > total).select(
            "token",
            F.least(side, F.col("_la")).cast("int").alias("_na"),
            F.least(side, F.col("_lg")).cast("int").alias("_ng"),
        )
    )
    dealt = kept.join(hot, "token", "left").select(
        "token", "bag", "unit", "n_a", "n_g",
        F.coalesce("_na", F.lit(1)).alias("_na"),
        F.coalesce("_ng", F.lit(1)).alias("_ng"),
    )

    def place(pieces: str) -> Column:
        return F.pmod(F.xxhash64("bag"), F.col(pieces)).cast("int")

    def every(pieces: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))

    a = dealt.filter("n_a > 0").select(
        "token", F.col("bag").alias("bag_a"), F.col("unit").alias("unit_a"), F.col("n_a"),
        place("_na").alias("_pa"), every("_ng").alias("_pg"),
    )
    g = dealt.filter("n_g > 0").select(
        "token", F.col("bag").alias("bag_g"), F.col("unit").alias("unit_g"), F.col("n_g"),
        place("_ng").alias("_pg"), every("_na").alias("_pa"),
    )
    return (
        a.join(g, ["token", "_pa", "_pg"])
        .groupBy("bag_a", "bag_g")
        .agg(F.sum(F.col("unit_a") * F.col("unit_g")).alias("cosine"), F.max("n_a").alias("n_a"), F.max("n_g").alias("n_g"))
    )


def bounded_pairs(catalogues: Catalogues, cut: float) -> DataFrame:
    """(bag_a, bag_g, cosine, n_a, n_g): the pairs that share a kept token, with the products of
    these tokens alone, which are at most `cut` below the cosine and never above it.

    Each unit vector drops its commonest tokens, up to a length of `cut`. Of two vectors one drops
    the longer stretch of the common order of tokens, which holds all that either drops: there
    its own part has at most the length `cut` and the other's at most 1, so what is missing from
    the product is at most `cut`. How common a token may be before it is dropped doesn't grow
    with the number of records, so hot tokens are joined only for records made of nothing else.
    """
    return _shared_token_products(postings(catalogues.vectors, ["bag", "n_a", "n_g"], cut))


def pair_cosines(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Exact cosine of the given (bag_a, bag_g) pairs, as PAIR columns and `cosine`;
    pairs sharing no token drop out. A pair's two vectors meet in one row; with few pairs only the
    vectors that they name are shuffled."""
    a = vectors.select("n_a", "a_id", F.col("bag").alias("bag_a"), F.col("codes").alias("codes_a"), F.col("units").alias("units_a"))
    g = vectors.select("n_g", "g_id", F.col("bag").alias("bag_g"), F.col("codes").alias("codes_g"), F.col("units").alias("units_g"))
    found = met(settle(pairs.select("bag_a", "bag_g")), a, g, ["bag_a", "bag_g"])
    found = found.select(*PAIR, "codes_a", "units_a", "codes_g", "units_g")
    return dot_products(found, ("codes_a", "units_a"), ("codes_g", "units_g"), "cosine")


def similar_pairs(catalogues: Catalogues, min_similarity: float) -> DataFrame:
    """Every pair of bags, one from each side, with cosine >= `min_similarity`:
    bag_a, bag_g, cosine, n_a, n_g, a_id, g_id. Exact for any value.

    The pairs whose kept tokens (`bounded_pairs`, dropping up to half of `min_similarity`) reach
    the other half are scored on their whole vectors. `min_similarity` must be above 0: all pairs
    that share a token would grow with the square of the commonest token's records.
    """
    if min_similarity <= 0:
        raise ValueError("min_similarity must be above 0")
    cut = min_similarity / 2
    likely = bounded_pairs(catalogues, cut).filter(F.col("cosine") >= min_similarity - cut - NOISE)
    scored = pair_cosines(likely.select("bag_a", "bag_g"), catalogues.vectors)
    return scored.filter(F.round("cosine", 9) >= min_similarity)


def gold_similarities(catalogues: Catalogues, gold: DataFrame) -> DataFrame:
    """`gold` (a_id, g_id) with its cosine; `known` tells whether both records exist.
    A pair sharing no token, or with a missing record, scores 0."""
    members = catalogues.members
    a = members.filter("side = 'a'").select(F.col("id").alias("a_id"), F.col("bag").alias("bag_a"))
    g = members.filter("side = 'g'").select(F.col("id").alias("g_id"), F.col("bag").alias("bag_g"))
    placed = gold.join(a, "a_id", "left").join(g, "g_id", "left")
    wanted = placed.select("bag_a", "bag_g").dropna().distinct()
    scores = pair_cosines(wanted, catalogues.vectors).select("bag_a", "bag_g", "cosine")
    return placed.join(scores, ["bag_a", "bag_g"], "left").select(
        "a_id",
        "g_id",
        F.coalesce("cosine", F.lit(0.0)).alias("cosine"),
        (F.col("bag_a").isNotNull() & F.col("bag_g").isNotNull()).alias("known"),
    )


def record_pairs(catalogues: Catalogues) -> Column:
    """Number of (a, g) record pairs, zeros included, as a one-value subquery."""
    sides = catalogues.bags.agg(F.sum("n_a").alias("a"), F.sum("n_g").alias("g"))
    return sides.select(F.col("a") * F.col("g")).scalar()


def total_similarity(catalogues: Catalogues) -> Column:
    """Sum of the cosines of all record pairs, as a one-value subquery."""
    units = F.inline(F.arrays_zip(F.col("codes").alias("token"), F.col("units").alias("unit")))
    per_token = catalogues.vectors.select("n_a", "n_g", units).groupBy("token").agg(
        F.sum(F.col("unit") * F.col("n_a")).alias("a"),
        F.sum(F.col("unit") * F.col("n_g")).alias("g"),
    )
    return per_token.agg(F.sum(F.col("a") * F.col("g"))).scalar()


def duplicate_means(catalogues: Catalogues, gold: DataFrame) -> DataFrame:
    """Mean cosine of the gold pairs and of all other pairs."""
    known = gold_similarities(catalogues, gold).filter("known")
    dups = known.agg(F.count(F.lit(1)).alias("n_dups"), F.sum("cosine").alias("_sum"))
    return dups.select(
        "n_dups",
        F.try_divide(F.col("_sum"), F.col("n_dups")).alias("mean_dups"),
        F.try_divide(
            total_similarity(catalogues) - F.col("_sum"),
            record_pairs(catalogues) - F.col("n_dups"),
        ).alias("mean_others"),
    )


def similarity_bin(cosine: Column) -> Column:
    """Hundredth the similarity falls in, after rounding off summation noise."""
    return F.floor(F.round(cosine * 100, 7)).cast("int")


def similarity_histogram(catalogues: Catalogues, gold: DataFrame) -> DataFrame:
    """One row per bin 0..100: `pairs` (all record pairs in the bin), `golds` (gold
    pairs in it, unmatched ones in bin 0) and `others` = pairs - golds.

    Bins from 1 up come from the products of blocks of vectors (`cosine_bins`), which count pairs
    and never list them. Bin 0 is what is left of all record pairs, so the zero and near-zero
    pairs are counted without being told apart.
    """
    spark = catalogues.vectors.sparkSession
    a, g = (catalogues.vectors.filter(F.col(n) > 0).select("bag", "codes", "units", F.col(n).alias("n")) for n in ("n_a", "n_g"))
    found = cosine_bins(a, g, BINS - 1, "bag").withColumnRenamed("pairs", "_pairs")
    golds = (
        gold_similarities(catalogues, gold)
        .groupBy(similarity_bin(F.col("cosine")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("_golds"))
    )
    every_bin = spark.range(BINS).select(F.col("id").cast("int").alias("bin"))
    table = (
        every_bin.join(F.broadcast(found), "bin", "left")
        .join(F.broadcast(golds), "bin", "left")
        .select(
            "bin",
            F.coalesce("_pairs", F.lit(0)).cast("bigint").alias("_pairs"),
            F.coalesce("_golds", F.lit(0)).cast("bigint").alias("golds"),
        )
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    listed = F.sum("_pairs").over(everything)  # 101 rows
    pairs = F.when(F.col("bin") == 0, record_pairs(catalogues) - listed).otherwise(F.col("_pairs"))
    return table.select("bin", pairs.cast("bigint").alias("pairs"), "golds").withColumn(
        "others", F.col("pairs") - F.col("golds")
    )


def threshold_sweep(histogram: DataFrame) -> DataFrame:
    """False/true positives, false negatives, precision, recall and F-measure at the
    thresholds 0.00 ... 0.99, from the 101-row histogram."""
    upward = Window.orderBy("bin").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tallied = histogram.select(
        "bin",
        F.sum("others").over(upward).alias("fp"),
        F.sum("golds").over(upward).alias("tp"),
        F.sum("golds").over(everything).alias("_golds"),
    ).filter(F.col("bin") < BINS - 1)
    rated = tallied.select(
        (F.col("bin") / 100.0).alias("threshold"),
        "fp",
        (F.col("_golds") - F.col("tp")).alias("fn"),
        "tp",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("_golds")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("fmeasure", F.try_divide(2 * r * p, r + p))
