"""Sums, line counts and word counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import tokens as K
from millrace.operators.ordering import top_rows, with_ordinal
from millrace.plans import inputs as I


def range_sum(spark, sf_dir):
    return I.table(spark, sf_dir, "orders").agg(F.sum("o_orderkey").alias("total"))


def filter_mod_sum(spark, sf_dir):
    keys = I.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 7 == 0)
    return keys.agg(F.sum("o_orderkey").alias("total"))


def line_count(spark, sf_dir):
    return I.text_lines(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_lines"))


def _counts(spark, sf_dir):
    return K.word_counts(K.word_rows(I.text_lines(spark, sf_dir)))


def word_count(spark, sf_dir):
    return _counts(spark, sf_dir)


def top_words(spark, sf_dir):
    return top_rows(_counts(spark, sf_dir), "n", ["word"], 15)


def all_word_count(spark, sf_dir):
    """Words with and without the empty ones that double blanks leave."""
    return K.word_rows(I.text_lines(spark, sf_dir), keep_empty=True).agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.length("word") > 0).alias("n_words")
    )


def last_words(spark, sf_dir):
    """The five greatest words in natural order, repeats kept."""
    return K.word_rows(I.text_lines(spark, sf_dir)).orderBy(F.desc("word")).limit(5)


def mean_word_occurrence(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return counts.agg(
        F.sum("n").alias("n_words"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.round(F.sum("n") / F.count(F.lit(1)), 2).alias("mean_uses"),
    )


def plural_words(spark, sf_dir):
    return _counts(spark, sf_dir).select("word", T.plural(F.col("word")).alias("plural_word"))


def word_lengths(spark, sf_dir):
    """How many words, made plural, have each length."""
    rows = K.word_rows(I.text_lines(spark, sf_dir))
    return rows.groupBy(F.length(T.plural(F.col("word"))).alias("length")).agg(
        F.count(F.lit(1)).alias("n")
    )


def grouped_words(spark, sf_dir):
    """The (word, 1) pairs grouped by word, equal members counted, and their sum."""
    pairs = K.word_rows(I.text_lines(spark, sf_dir)).select("word", F.lit(1).alias("member"))
    return K.counted_members(pairs, "word", "member").withColumn(
        "total", F.col("member") * F.col("n")
    )


def numbered_lines(spark, sf_dir):
    lines = with_ordinal(I.text_lines(spark, sf_dir), ["doc_id", "pos"], "line_no")
    return lines.select("line_no", F.concat_ws(": ", "line_no", T.clean(F.col("line"))).alias("text"))


QUERIES = {
    f.__name__: f
    for f in (
        range_sum, filter_mod_sum, line_count, word_count, top_words, all_word_count, last_words,
        mean_word_occurrence, plural_words, word_lengths, grouped_words, numbered_lines,
    )
}
