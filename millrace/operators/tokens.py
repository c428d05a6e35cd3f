"""Word counts, token bags and TF-IDF weights, all in long form."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from millrace.functions import text as T
from millrace.operators.vectors import document_tokens, lists_of, slices, spelt_counts, through, token_table, weighed_tokens
from millrace.session import settle

#: bytes of text that are cut at once, and tokens whose records are counted at once
CUT_BYTES, COUNTED = 1 << 23, 1 << 21


def word_rows(lines: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per word of the cleaned lines."""
    rows = lines.select(F.explode(T.words(T.clean(F.col("line")))).alias("word"))
    return rows if keep_empty else rows.filter(F.length("word") > 0)


def word_counts(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def counted_members(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """The values of each group as counted members: (key, value, n).

    This holds the same content as a list per key but is combined before the shuffle,
    and no task ever has to hold one key's whole list.
    """
    return pairs.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))


def token_bags(records: DataFrame, stop_words: DataFrame | None = None) -> DataFrame:
    """Replace `text` by `tokens` (as `functions.text.tokens` cuts it), without stop words."""
    kept = [c for c in records.columns if c != "text"]
    plain = records.select(*kept, "text")
    schema = StructType([*plain.schema.fields[:-1], *StructType.fromDDL("tokens array<string>").fields])
    bags = through(plain, _cut_texts(kept), schema)
    return bags if stop_words is None else without_words(bags, stop_words)


def _cut_texts(columns):
    """`text` as `tokens`, whole batches of bytes at once: of the bytes only ASCII letters, digits and
    underscores are parts of tokens, and no other character's UTF-8 form has such a byte."""
    import numpy as np
    import pyarrow as pa

    lower = np.zeros(256, dtype=np.uint8)
    for c in string.ascii_letters + string.digits + "_":
        lower[ord(c)] = ord(c.lower())

    def cut(texts):
        n = len(texts)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if offsets else np.zeros(n + 1, dtype=np.int64)
        data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, dtype=np.uint8)
        ends = ends - ends[0]
        spelt = lower[data]
        word = spelt > 0
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        rows = ends[:-1][ends[:-1] < len(word)]
        begins[rows] = word[rows]
        letters, first = spelt[word], np.flatnonzero(begins[word])
        places = np.append(first, len(letters)).astype(np.int32)
        tokens = pa.StringArray.from_buffers(len(first), pa.py_buffer(places), pa.py_buffer(letters))
        return lists_of(np.searchsorted(np.flatnonzero(begins), ends), tokens, texts)

    def bags(batches):
        for whole in batches:
            for first, n in slices(whole.column("text").cast(pa.binary()), CUT_BYTES):
                batch = whole.slice(first, n)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], cut(batch.column("text"))], names=[*columns, "tokens"])

    return bags


def without_words(bags: DataFrame, stop_words: DataFrame) -> DataFrame:
    """The bags less the stop words (word). The stop list is a parameter of fixed size."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    listed = [r["word"] for r in stop_words.select("word").collect() if r["word"] is not None]
    columns = [c for c in bags.columns if c != "tokens"]

    def without(batches):
        words = pa.array(listed, pa.string())
        for batch in batches:
            lists = batch.column("tokens")
            tokens = lists.flatten()
            kept = pc.invert(pc.is_in(tokens, value_set=words))
            before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], lists_of(before[ends], tokens.filter(kept), lists)], names=[*columns, "tokens"])

    return through(bags, without, StructType([bags.schema[c] for c in [*columns, "tokens"]]))


def token_total(bags: DataFrame) -> DataFrame:
    return bags.agg(F.sum(F.size("tokens")).cast("bigint").alias("n_tokens"))


def document_counts(bags: DataFrame) -> DataFrame:
    """(token, n_docs): records that hold the token at least once."""
    return _counted_records(bags).filter(F.col("token").isNotNull())


def _counted_records(bags: DataFrame) -> DataFrame:
    """(token, n_docs), and the number of all records with a NULL token. Tasks count many records'
    tokens at once and send sums."""
    counted = through(bags if hasattr(bags, "_steps") else bags.select("tokens"), document_tokens(COUNTED), "token string, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n_docs"))


def inverse_ratios(bags: DataFrame) -> DataFrame:
    """(token, n_docs, idf) with idf = records / records holding the token, no log.

    One pass counts both: the NULL row is the number of records. The counts are written once, as
    every use needs them whole.
    """
    counts = settle(_counted_records(bags))
    records = counts.filter(F.col("token").isNull()).select("n_docs").scalar()
    return counts.filter(F.col("token").isNotNull()).withColumn(
        "idf", records / F.col("n_docs")
    )


def _one_row_a_key(bags: DataFrame, key: str) -> DataFrame:
    """(key, _len, tokens): the bags, where rows that share a key and a length are one. Keys are told
    apart first, as a rule by themselves: then no tokens are shuffled."""
    sized = bags.select(key, F.size("tokens").alias("_len"), "tokens")
    if bags.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        return sized
    return sized.groupBy(key, "_len").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))


def term_frequencies(bags: DataFrame, key: str) -> DataFrame:
    """(key, token, tf): share of the record's tokens, counted within the record."""
    counted = spelt_counts(_one_row_a_key(bags, key), [key, "_len"])
    return counted.select(key, "token", (F.col("n") / F.col("_len")).alias("tf"))


def tfidf(bags: DataFrame, key: str, ratios: DataFrame | None = None) -> DataFrame:
    """(key, token, weight) with weight = tf x idf. A token outside `ratios` is dropped.

    The commonest tokens are weighed where they are; rarer ones are joined, spread over many shuffle
    keys where needed: how often each token occurs is known from its document count.
    """
    table = token_table(inverse_ratios(bags) if ratios is None else ratios)
    return weighed_tokens(_one_row_a_key(bags, key), table, key, "_len")


def weight_norms(weights: DataFrame, key: str) -> DataFrame:
    return weights.groupBy(key).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")
    )


def equal_width_histogram(values: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts over equal bins between the least and the greatest value; the last bin
    takes the greatest value too."""
    low = values.agg(F.min(column)).scalar()
    high = values.agg(F.max(column)).scalar()
    place = F.floor(F.try_divide(F.col(column) - low, high - low) * bins)
    binned = values.select(
        F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")
    )
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
