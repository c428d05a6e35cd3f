"""The inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import tokens as K
from millrace.session import settle
from millrace.sources import lines as S

STOP_WORDS = 20
NEW_USER = -1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, line): documents cut at line feeds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as access-log lines, some malformed, some with a stray blank."""
    stamp = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    code = (
        F.when(F.col("event_type") == "error", "404")
        .when(F.col("event_type") == "signup", "302")
        .when(F.col("event_type") == "purchase", "304")
        .otherwise("200")
    )
    size = F.when(F.col("event_id") % 13 == 0, "-").otherwise(
        F.floor(F.col("value") * 100).cast("bigint").cast("string")
    )
    line = F.concat(
        F.lit("host"), "user_id", F.lit(".example.com - - ["), stamp, F.lit(' -0400] "GET /'),
        "event_type", F.lit("/"), F.regexp_extract("props", "([0-9]+)", 1),
        F.lit(".html HTTP/1.0"), F.when(F.col("event_id") % 50 == 0, " ").otherwise(""),
        F.lit('" '), code, F.lit(" "), size,
    )
    garbage = F.concat(F.lit("garbage line "), "event_id")
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    return events.select(
        F.when(F.col("event_id") % 97 == 0, garbage).otherwise(line).alias("value")
    )


def access_log(spark: SparkSession, sf_dir: str, pattern: str = S.LOG_RELAXED) -> DataFrame:
    return S.parse_log(log_lines(spark, sf_dir), pattern)


def good_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_log(spark, sf_dir).filter(F.col("status") == S.VALID)


def text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as two catalogues: sources src0-src9 are side a, the others side g."""
    side = F.when(F.length("source") == 4, "a").otherwise("g")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return docs.select(F.col("doc_id").alias("id"), side.alias("side"), "text")


def stop_words(bags: DataFrame) -> DataFrame:
    """The stop list: the tokens most documents hold."""
    common = K.document_counts(bags).orderBy(F.desc("n_docs"), "token").limit(STOP_WORDS)
    return settle(common.select(F.col("token").alias("word")))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, side, tokens) without stop words. Every use cuts the texts anew: that takes less than
    writing and reading lists of tokens."""
    bags = K.token_bags(text_records(spark, sf_dir))
    return K.without_words(bags, stop_words(bags))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as quoted product lines, with a header row and invalid rows."""
    line = F.concat(
        F.lit('"'), "lang", "doc_id", F.lit('","'), "source", F.lit(' title",'),
        F.translate("text", "\n", " "), F.lit(',"maker, inc",'), F.col("n_chars").cast("string"),
    )
    bad = F.concat(F.lit("bad "), "doc_id")
    header = F.lit('"id","title","description","manufacturer","price"')
    docs = table(spark, sf_dir, "documents")
    row = F.when(F.col("doc_id") % 101 == 0, bad).otherwise(line)
    first = F.when(F.col("doc_id") == 0, F.array(header, row)).otherwise(F.array(row))
    return docs.select(F.explode(first).alias("value"))


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a_id, g_id): one pair per text found on both sides, and one unlike pair per
    language so that some gold pairs have no noteworthy similarity."""
    docs = table(spark, sf_dir, "documents")
    is_a = F.length("source") == 4
    a_id, g_id = F.when(is_a, F.col("doc_id")), F.when(~is_a, F.col("doc_id"))
    copies = docs.groupBy(F.md5(F.lower("text"))).agg(
        F.min(a_id).alias("a_id"), F.min(g_id).alias("g_id")
    )
    unlike = docs.groupBy("lang").agg(F.max(a_id).alias("a_id"), F.max(g_id).alias("g_id"))
    return copies.select("a_id", "g_id").union(unlike.select("a_id", "g_id")).dropna().distinct()


def gold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold pairs written as mapping lines, with a header and invalid rows."""
    pair = F.concat(F.lit('"a'), "a_id", F.lit('","g'), "g_id", F.lit('"'))
    pairs = gold_pairs(spark, sf_dir).select(
        F.when(F.col("a_id") % 7 == 0, F.concat(F.lit("no comma "), "a_id")).otherwise(pair)
        .alias("value")
    )
    header = table(spark, sf_dir, "documents").groupBy().agg(
        F.concat(F.lit('"idAmazon","'), F.min("lang"), F.lit('"')).alias("value")
    )
    return pairs.unionByName(header)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(usr, item, rating): what a customer bought, rated by the largest quantity."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rating = F.floor((F.col("l_quantity") - 1) / 10) + 1
    return (
        items.join(orders, items.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").cast("int").alias("usr"), F.col("l_partkey").cast("int").alias("item"))
        .agg(F.max(rating.cast("double")).alias("rating"))
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title")
    )


def own_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new user's ratings of one brand's promotional parts; parts of size 10 or less
    are rated twice."""
    liked = table(spark, sf_dir, "part").filter("p_brand = 'Brand#7' and p_type = 'PROMO'")
    rating = (F.col("p_size") % 5 + 1).cast("double")
    twice = F.when(F.col("p_size") <= 10, F.array(rating, F.lit(5.0))).otherwise(F.array(rating))
    return liked.select(
        F.lit(NEW_USER).alias("usr"),
        F.col("p_partkey").cast("int").alias("item"),
        F.explode(twice).alias("rating"),
    )


def row_id():
    """No two line items agree in all of these."""
    keys = ["orderkey", "linenumber", "partkey", "suppkey"]
    quantity = F.col("l_quantity").cast("bigint")
    return F.concat_ws("-", *[F.col("l_" + key).cast("string") for key in keys], quantity)


def regression_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, label, features[3]) from line items."""
    features = F.array(
        F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10
    )
    needed = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax"]
    return table(spark, sf_dir, "lineitem").select(*needed).select(
        row_id().alias("row_id"),
        (F.col("l_extendedprice") / 1000).alias("label"),
        features.alias("features"),
    )


def click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, value): line items with their part as label-first category rows; every
    tenth order is tab separated and the last category is blank."""
    needed = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_returnflag", "l_linestatus"]
    items = table(spark, sf_dir, "lineitem").select(*needed)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    fields = [
        F.when(F.col("l_quantity") > 40, "1").otherwise("0"), F.col("l_returnflag"),
        F.col("l_linestatus"), F.col("p_brand"), F.col("p_type"),
        F.col("p_size").cast("string"), F.lit(""),
    ]
    joined = items.join(parts, items.l_partkey == parts.p_partkey)
    value = F.when(F.col("l_orderkey") % 10 == 0, F.concat_ws("\t", *fields)).otherwise(
        F.concat_ws(",", *fields)
    )
    return joined.select(row_id().alias("row_id"), value.alias("value"))


def click_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, label, feats)."""
    parsed = S.parse_clicks(click_lines(spark, sf_dir))
    return parsed.filter(F.col("status") == S.VALID).select("row_id", "label", "feats")


def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, score) for the labelled documents; scores have ties."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return labels.join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").cast("double").alias("label"),
        ((F.col("n_chars") % 1000) / 1000.0).alias("score"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(x, y, series): embeddings lifted by 1 so that means stay away from zero."""
    lifted = F.transform("embedding", lambda v: v.cast("double") + 1.0)
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 25).cast("int").alias("x"),
        F.expr("vec_id div 25").cast("int").alias("y"),
        lifted.alias("series"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, features)."""
    wide = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", wide.alias("features"))
