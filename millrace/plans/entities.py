"""Entity resolution over two catalogues of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import similarity as R
from millrace.operators import tokens as K
from millrace.plans import inputs as I
from millrace.session import settle
from millrace.sources import lines as S


def _bag_rows(bags):
    return bags.select(
        "id", F.size("tokens").alias("n_tokens"), F.concat_ws(" ", "tokens").alias("token_text")
    )


def _stored(spark, sf_dir):
    """The records with the stop words taken out once, for queries that go over them several times."""
    return settle(I.records(spark, sf_dir))


def doc_tokens(spark, sf_dir):
    return _bag_rows(K.token_bags(I.text_records(spark, sf_dir)))


def stopword_filter(spark, sf_dir):
    return _bag_rows(I.records(spark, sf_dir))


def token_total(spark, sf_dir):
    return K.token_total(I.records(spark, sf_dir))


def biggest_record(spark, sf_dir):
    """The record with most tokens on each side; ties go to the least id."""
    sized = I.records(spark, sf_dir).select("side", "id", F.size("tokens").alias("n_tokens"))
    biggest = F.max(F.struct("n_tokens", (-F.col("id")).alias("back")))
    return sized.groupBy("side").agg(biggest.alias("top")).select(
        "side", (-F.col("top.back")).alias("id"), "top.n_tokens"
    )


def tf(spark, sf_dir):
    rates = K.term_frequencies(_stored(spark, sf_dir), "id")
    return rates.select("id", "token", F.round("tf", 9).alias("tf"))


def idf(spark, sf_dir):
    ratios = K.inverse_ratios(I.records(spark, sf_dir))
    return ratios.select("token", "n_docs", F.round("idf", 6).alias("idf"))


def rare_idf(spark, sf_dir):
    """The eleven least inverse ratios: the most widespread tokens."""
    ratios = K.inverse_ratios(I.records(spark, sf_dir)).orderBy("idf", "token").limit(11)
    return ratios.select("token", F.round("idf", 6).alias("idf"))


def idf_histogram(spark, sf_dir):
    return K.equal_width_histogram(K.inverse_ratios(I.records(spark, sf_dir)), "idf", 50)


def tfidf(spark, sf_dir):
    weights = K.tfidf(_stored(spark, sf_dir), "id")
    return weights.select("id", "token", F.round("weight", 6).alias("weight"))


def weight_norms(spark, sf_dir):
    norms = K.weight_norms(K.tfidf(_stored(spark, sf_dir), "id"), "id")
    return norms.select("id", F.round("norm", 6).alias("norm"))


def product_csv_parse(spark, sf_dir):
    parsed = S.parse_products(I.product_lines(spark, sf_dir))
    return parsed.filter(F.col("status") == S.VALID).select("id", "text")


def product_load_counts(spark, sf_dir):
    return S.status_counts(S.parse_products(I.product_lines(spark, sf_dir)))


def product_rejects(spark, sf_dir):
    return S.rejects(S.parse_products(I.product_lines(spark, sf_dir)), -1, 10)


def gold_parse(spark, sf_dir):
    parsed = S.parse_gold(I.gold_lines(spark, sf_dir))
    return parsed.select("status", "a_id", "g_id")


def _catalogues(spark, sf_dir):
    return R.build_catalogues(I.records(spark, sf_dir))


def record_bags(spark, sf_dir):
    """Which records share a bag of tokens: the key to the pair lists."""
    members = _catalogues(spark, sf_dir).members
    return members.select("side", "id", F.col("spelling").alias("bag"))


def similar_pairs(spark, sf_dir):
    found = R.similar_pairs(_catalogues(spark, sf_dir), 0.1)
    return found.select("a_id", "g_id", "n_a", "n_g", F.round("cosine", 6).alias("cosine"))


def gold_left_join(spark, sf_dir):
    scored = R.gold_similarities(_catalogues(spark, sf_dir), I.gold_pairs(spark, sf_dir))
    return scored.select("a_id", "g_id", F.round("cosine", 6).alias("cosine"))


def dup_vs_nondup_mean(spark, sf_dir):
    means = R.duplicate_means(_catalogues(spark, sf_dir), I.gold_pairs(spark, sf_dir))
    return means.select(
        "n_dups",
        F.round("mean_dups", 6).alias("mean_dups"),
        F.round("mean_others", 9).alias("mean_others"),
    )


def _histogram(spark, sf_dir):
    return R.similarity_histogram(_catalogues(spark, sf_dir), I.gold_pairs(spark, sf_dir))


def similarity_histogram(spark, sf_dir):
    return _histogram(spark, sf_dir)


def pr_sweep(spark, sf_dir):
    sweep = R.threshold_sweep(_histogram(spark, sf_dir))
    rounded = [F.round(c, 9).alias(c) for c in ("precision", "recall", "fmeasure")]
    return sweep.select("threshold", "fp", "fn", "tp", *rounded)


QUERIES = {
    f.__name__: f
    for f in (
        doc_tokens, stopword_filter, token_total, biggest_record, tf, idf, rare_idf,
        idf_histogram, tfidf, weight_norms, product_csv_parse, product_load_counts,
        product_rejects, gold_parse, record_bags, similar_pairs, gold_left_join,
        dup_vs_nondup_mean, similarity_histogram, pr_sweep,
    )
}
