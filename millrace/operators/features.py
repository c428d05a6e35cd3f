"""Categorical click rows (row_id, label, feats) to sparse features."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from millrace.functions.scores import count_bucket
from millrace.operators.joins import spread_join
from millrace.operators.ordering import with_ordinal

KEYS = ["idx", "cat"]
#: a dictionary within both bounds is broadcast
HELD_FEATURES, HELD_BYTES = 1 << 17, 8 << 20


def feature_counts(rows: DataFrame) -> DataFrame:
    """(idx, cat, n): rows holding each feature."""
    return rows.select(F.inline("feats")).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))


def counted_rows(rows: DataFrame, *by: str) -> DataFrame:
    """(`by`, label, feats, n): equal rows as one with their number n, so that what is worked out from
    the features is worked out once for all of them."""
    return rows.groupBy(*by, "label", "feats").agg(F.count(F.lit(1)).alias("n"))


def categories_per_feature(rows: DataFrame) -> DataFrame:
    return feature_counts(rows).groupBy("idx").agg(F.count(F.lit(1)).alias("n_categories"))


def feature_dictionary(rows: DataFrame) -> DataFrame:
    """(idx, cat, n, ordinal), ordinals 0, 1, 2, ... in (idx, cat) order. It stays a
    table: it may grow with the data, so it is neither collected nor broadcast."""
    return with_ordinal(feature_counts(rows), KEYS)


def unseen_features(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(row_id, idx, cat): feature uses the dictionary does not know. Strict encoding wants none."""
    looked_up = _looked_up(rows, dictionary, dictionary, "ordinal")
    return looked_up.filter("ordinal is null and idx is not null").select("row_id", *KEYS)


def _looked_up(rows: DataFrame, known: DataFrame, dictionary: DataFrame, value: str) -> DataFrame:
    """(_row, row_id, label, idx, cat, `value`): a row a feature use, with NULL where `known` (idx, cat,
    `value`) has none, and one for a row without features. `_row` tells rows apart that share a
    row_id; read `rows` from a table.

    A small dictionary, by its measured rows and bytes, goes to every task; with a larger one the
    uses are dealt, and it knows how common each is, so nothing is counted again.
    """
    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), "row_id", "label", "feats")
    uses = numbered.select("_row", "row_id", "label", F.expr("inline_outer(feats)"))
    known = known.select(*KEYS, value)
    if _is_held(dictionary):
        return uses.join(F.broadcast(known), KEYS, "left")
    return spread_join(uses, known, KEYS, ["_row"], sizes=dictionary.select(*KEYS, "n"), how="left")


def _is_held(dictionary: DataFrame) -> bool:
    size = dictionary.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("cat")), F.lit(0)).alias("bytes")).first()
    return size["n"] <= HELD_FEATURES and size["bytes"] <= HELD_BYTES


def _ordinals_within(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(row_id, label, indices): a row's features looked up within the row in a dictionary that every task
    holds. A NULL category is in none."""
    found = [r for r in dictionary.select(*KEYS, "ordinal").collect() if r["idx"] is not None and r["cat"] is not None]
    places = {cat: i for i, cat in enumerate(dict.fromkeys(r["cat"] for r in found))}
    keys = np.array([r["idx"] * len(places) + places[r["cat"]] for r in found], dtype=np.int64)
    order = np.argsort(keys)
    shared = rows.sparkSession.sparkContext.broadcast(
        (pa.array(list(places), pa.string()), keys[order], np.array([r["ordinal"] for r in found], dtype=np.int64)[order]))

    def look_up(batches):
        cats, keys, ordinals = shared.value
        for batch in batches:
            lists = batch.column("feats")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            idx, cat = lists.flatten().flatten()
            at = pc.index_in(cat, value_set=cats).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            at[idx.is_null().to_numpy(zero_copy_only=False)] = -1
            wanted = idx.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) * len(cats) + at
            place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            known = (at >= 0) & (keys[place] == wanted) if len(keys) else np.zeros(len(wanted), dtype=bool)
            row, ordinal = row[known], ordinals[place[known]] if len(keys) else np.zeros(0, dtype=np.int64)
            ordinal = ordinal[np.lexsort((ordinal, row))]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("label"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ordinal))],
                names=["row_id", "label", "indices"])

    needed = rows.select("row_id", "label", "feats")
    return needed.mapInArrow(look_up, StructType([*needed.schema.fields[:2], *StructType.fromDDL("indices array<bigint>").fields]))


def one_hot(rows: DataFrame, dictionary: DataFrame, strict: bool = False) -> DataFrame:
    """(row_id, label, indices, values) with sorted indices. A row's list is as long as its own
    features, so gathering it back is bounded; unseen features are skipped, or raise a KeyError
    if `strict`. With a small dictionary nothing is shuffled; else label and row_id travel with the
    uses, so no row is joined again."""
    if strict and not unseen_features(rows, dictionary).isEmpty():
        raise KeyError("the dictionary lacks some features of these rows")
    if _is_held(dictionary):
        gathered = _ordinals_within(rows, dictionary)
    else:
        gathered = _looked_up(rows, dictionary, dictionary, "ordinal").groupBy("_row").agg(
            F.first("row_id").alias("row_id"), F.first("label").alias("label"), F.sort_array(F.collect_list("ordinal")).alias("indices"))
    return gathered.select("row_id", "label", "indices", F.transform("indices", lambda _: F.lit(1.0)).alias("values"))


def hashed(rows: DataFrame, buckets: int) -> DataFrame:
    """(row_id, label, indices, values): features hashed to `buckets` places. Counted rows have n in
    place of row_id, and keep it.

    A row's features are told apart by category text + position, repeats collapse and
    different features meeting in a bucket add up. Works within the row: no shuffle. A task hashes
    a feature once for all rows of a batch, and keeps the last HELD_FEATURES for the next ones.
    """
    if not 0 < buckets < 2**31:
        raise ValueError("buckets must lie between 1 and 2**31 - 1")
    kept = [c for c in ("row_id", "label", "n") if c in rows.columns]

    def place(batches):
        known: dict[str, int] = {}
        for batch in batches:
            lists = batch.column("feats")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            idx, cat = lists.flatten().flatten()
            if len(known) > HELD_FEATURES:
                known.clear()
            names = pc.binary_join_element_wise(cat, idx.cast(pa.string()), "").dictionary_encode()
            places = np.array([_bucket(name, buckets, known) for name in names.dictionary.to_pylist()] + [buckets], dtype=np.int64)
            name = names.indices.fill_null(len(places) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            used = np.unique(row * len(places) + name)  # a row's features, each once
            met, counts = np.unique(used // len(places) * (buckets + 1) + places[used % len(places)], return_counts=True)
            found, index = met // (buckets + 1), met % (buckets + 1)
            unnamed = index == buckets  # a NULL feature has no place and counts for nothing
            gone = pa.array(np.append(lists.is_null().to_numpy(zero_copy_only=False), False))
            offsets = pc.if_else(gone, None, pa.array(np.searchsorted(found, np.arange(batch.num_rows + 1)), pa.int32()))
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in kept],
                pa.ListArray.from_arrays(offsets, pa.array(index.astype(np.int32), mask=unnamed)),
                pa.ListArray.from_arrays(offsets, pa.array(np.where(unnamed, 0.0, counts))),
            ], names=[*kept, "indices", "values"])

    needed = rows.select(*kept, "feats")
    return needed.mapInArrow(place, StructType([*needed.schema.fields[:-1], *StructType.fromDDL("indices array<int>, values array<double>").fields]))


def _bucket(name: str, buckets: int, known: dict[str, int]) -> int:
    """`md5_bucket` of one text."""
    if name not in known:
        known[name] = int.from_bytes(hashlib.md5(name.encode()).digest()) % buckets
    return known[name]


def count_bucket_histogram(counts: DataFrame) -> DataFrame:
    """Features per power-of-two bucket of their count; counts above 1024 are left out."""
    bucketed = counts.select(count_bucket(F.col("n")).alias("bucket"))
    return bucketed.filter(F.col("bucket") != -1).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_features")
    )


def nonzeros(sparse: DataFrame) -> DataFrame:
    return sparse.agg(F.sum(F.size("indices")).cast("bigint").alias("n_nonzero"))


def sparsity(sparse: DataFrame, width: Column) -> DataFrame:
    """Mean share of non-zero places per row."""
    return sparse.agg(F.avg(F.size("indices") / width).alias("sparsity"))


def first_rows_total(rows: DataFrame, value: Column, first: int) -> DataFrame:
    """Total of a value over the first rows in row_id order."""
    head = rows.select("row_id", value.alias("_value")).orderBy("row_id").limit(first)
    return head.agg(F.sum("_value").alias("total"))


def weighted_scores(
    rows: DataFrame, dictionary: DataFrame, weights: DataFrame, intercept: float
) -> DataFrame:
    """(row_id, label, raw_score) of one-hot rows for weights (ordinal, weight).

    Weights join the dictionary first (one row per feature), then the rows.
    """
    known = dictionary.join(weights, "ordinal").select(*KEYS, "weight")
    sums = _looked_up(rows, known, dictionary, "weight").groupBy("_row").agg(
        F.first("row_id").alias("row_id"), F.first("label").alias("label"), F.sum("weight").alias("_sum"))
    return sums.select(
        "row_id", "label", (F.coalesce("_sum", F.lit(0.0)) + F.lit(intercept)).alias("raw_score")
    )
