"""Records' tokens as vectors of numbered tokens, a row a vector.

Postings are never shuffled one by one: a task numbers the common tokens of its records by
itself, and only the uses of rarer ones travel to the table of tokens and back.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from millrace.operators.joins import spread_join
from millrace.operators.ordering import with_ordinal
from millrace.session import settle

#: the tokens that every task holds: the commonest, at most so many and of so many bytes
HELD_TOKENS, HELD_BYTES = 1 << 17, 8 << 20
#: tokens that are taken apart, or postings that are multiplied, at once
SLICE = 1 << 20
CODE_BITS = 40
HELD_PAIRS = 1 << 18  # pairs that every task may hold, 16 bytes each
COUNTS = ["codes", "uses", "rare", "rare_uses"]


def give_back() -> None:
    """Hand freed memory back to the system: workers live on between tasks, beside the executor's heap."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def tidy(work):
    """The same work on a task's batches, giving freed memory back at the end."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def through(rows: DataFrame, step, schema) -> DataFrame:
    """`rows` through `step`, a function over Arrow batches. Steps that follow one another run in one
    Python pass, so lists of tokens that lie between them never become rows."""
    source, before = getattr(rows, "_steps", (rows, ()))
    steps = (*before, step)

    def run(batches):
        for each in steps:
            batches = each(batches)
        return batches

    out = source.mapInArrow(tidy(run), schema)
    out._steps = source, steps
    return out


def numbered_tokens(ratios: DataFrame) -> DataFrame:
    """`ratios` with `code`: 0, 1, 2, ... in the order of `n_docs`, commonest first, then of `token`."""
    ranked = ratios.withColumn("_back", -F.col("n_docs"))
    return settle(with_ordinal(ranked, ["_back", "token"], "code").drop("_back"))


def _held(terms: DataFrame):
    """The commonest tokens in the order of their codes, their idf, and the first code beyond them."""
    import numpy as np
    import pyarrow as pa

    length = F.octet_length("token")
    sizes = terms.filter(F.col("code") < HELD_TOKENS)
    per = sizes.agg(F.coalesce(F.max(length), F.lit(1)).alias("most"), F.coalesce(F.sum(length), F.lit(0)).alias("bytes")).first()
    first = HELD_TOKENS if per["bytes"] <= HELD_BYTES else min(HELD_TOKENS, max(HELD_BYTES // max(per["most"], 1), 0))
    rows = terms.filter(F.col("code") < first).select("token", "code", "idf").collect()
    rows.sort(key=lambda r: r["code"])
    return pa.array([r["token"] for r in rows], pa.string()), np.array([r["idf"] for r in rows], dtype=float), first


def slices(lists, most: int):
    """(first, length) of runs of rows that hold about `most` entries together, a row at least."""
    import numpy as np
    import pyarrow.compute as pc

    lengths = lists.value_lengths() if hasattr(lists, "value_lengths") else pc.binary_length(lists)
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(lists):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield first, last - first
        first = last


def _lists(rows, values, n, kind):
    """Values of rising row numbers as a list a row."""
    import numpy as np
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def lists_of(offsets, values, like):
    """Lists of `values` cut at `offsets`, null where `like` is."""
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=like.is_null() if like.null_count else None)


def _count_tokens(held, columns):
    """Replaces `tokens` by the held ones' `codes` and `uses`, and `rare` tokens with `rare_uses`."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def count(batches):
        common = held.value[0]
        for whole in batches:
            for first, n in slices(whole.column("tokens"), SLICE):
                batch = whole.slice(first, n)
                lists = batch.column("tokens")
                row = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                spelt = lists.flatten().dictionary_encode()
                at = pc.index_in(spelt.dictionary, value_set=common).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                width = max(len(at), 1)
                order = np.argsort(np.where(at < 0, len(common), at), kind="stable")
                rank = np.empty(len(at), dtype=np.int64)
                rank[order] = np.arange(len(at))
                index = spelt.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                keys, uses = np.unique(row * width + rank[index], return_counts=True)
                row, place = keys // width, order[keys % width]
                known = at[place] >= 0
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c) for c in columns],
                    _lists(row[known], at[place[known]].astype(np.int32), n, pa.int32()),
                    _lists(row[known], uses[known].astype(np.int32), n, pa.int32()),
                    _lists(row[~known], spelt.dictionary.take(pa.array(place[~known])).cast(pa.string()), n, None),
                    _lists(row[~known], uses[~known].astype(np.int32), n, pa.int32()),
                ], names=[*columns, "codes", "uses", "rare", "rare_uses"])

    return count


@dataclass(frozen=True)
class TokenTable:
    """`terms` (token, n_docs, idf, code) of which `held` (tokens, idf, first code beyond) goes to every task."""

    terms: DataFrame
    held: Broadcast


def token_table(ratios: DataFrame) -> TokenTable:
    terms = numbered_tokens(ratios)
    return TokenTable(terms, terms.sparkSession.sparkContext.broadcast(_held(terms)))


def counted_tokens(records: DataFrame, table: TokenTable) -> DataFrame:
    """`records` with COUNTS in place of their tokens, all of which the table knows: held tokens by
    their codes, rarer ones as they are. Nothing is shuffled."""
    columns = [c for c in records.columns if c != "tokens"]
    kinds = StructType.fromDDL("codes array<int>, uses array<int>, rare array<string>, rare_uses array<int>")
    return through(records, _count_tokens(table.held, columns), StructType([*[records.schema[c] for c in columns], *kinds.fields]))


def unit_vectors(counted: DataFrame, table: TokenTable, key: str) -> DataFrame:
    """Stored rows with COUNTS as vectors: the other columns, `codes` (rising, so commonest first) and
    `units`, the weights uses x idf over their norm. Rare tokens are the only postings that are
    joined one by one; a row then gets its own back by `key`."""
    columns = [c for c in counted.columns if c not in COUNTS]
    rare = counted.select(key, F.inline(F.arrays_zip(F.col("rare").alias("token"), F.col("rare_uses").alias("n"))))
    beyond = table.terms.filter(F.col("code") >= table.held.value[2])
    met = spread_join(rare, beyond.select("token", "code", "idf"), ["token"], [key],
                      beyond.select("token", F.col("n_docs").alias("n")))
    weighed = F.struct("code", (F.col("n") * F.col("idf")).alias("weight"))
    gathered = met.groupBy(key).agg(F.sort_array(F.collect_list(weighed)).alias("_rare"))
    joined = counted.drop("rare", "rare_uses").join(gathered, key, "left").select(
        *columns, "codes", "uses", F.col("_rare.code").alias("_code"), F.col("_rare.weight").alias("_weight"))
    kinds = StructType.fromDDL("codes array<bigint>, units array<double>")
    return joined.mapInArrow(tidy(_units(table.held, columns)), StructType([*joined.schema.fields[: len(columns)], *kinds.fields]))


def weighed_tokens(records: DataFrame, table: TokenTable, key: str, length: str) -> DataFrame:
    """(key, token, weight) with weight = uses / `length` x idf. Held tokens are weighed where they are;
    only rarer ones are joined, and those that the table lacks are dropped."""
    import numpy as np
    import pyarrow as pa

    counted = settle(counted_tokens(records.select(key, length, "tokens"), table))

    def weigh(batches):
        tokens, idf, _ = table_held.value
        for whole in batches:
            for first, n in slices(whole.column("codes"), SLICE):
                batch = whole.slice(first, n)
                row, code = rows_and_values(batch.column("codes"))
                _, uses = rows_and_values(batch.column("uses"))
                weight = uses / batch.column(length).to_numpy(zero_copy_only=False)[row] * idf[code] if len(row) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).take(pa.array(row)), tokens.take(pa.array(code, pa.int64())), pa.array(weight)],
                    names=[key, "token", "weight"])

    table_held = table.held
    narrow = counted.select(key, length, "codes", "uses")
    schema = StructType([narrow.schema[key], *StructType.fromDDL("token string, weight double").fields])
    rare = counted.select(key, length, F.inline(F.arrays_zip(F.col("rare").alias("token"), F.col("rare_uses").alias("n"))))
    beyond = table.terms.filter(F.col("code") >= table.held.value[2])
    met = spread_join(rare, beyond.select("token", "idf"), ["token"], [key], beyond.select("token", F.col("n_docs").alias("n")))
    joined = met.select(key, "token", (F.col("n") / F.col(length) * F.col("idf")).alias("weight"))
    return narrow.mapInArrow(weigh, schema).unionByName(joined)


def spelt_counts(records: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, token, n): a row's tokens with how often it has them, counted within the row."""
    import numpy as np
    import pyarrow as pa

    def count(batches):
        for whole in batches:
            for first, n in slices(whole.column("tokens"), SLICE):
                batch = whole.slice(first, n)
                lists = batch.column("tokens")
                row = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                spelt = lists.flatten().dictionary_encode()
                width = max(len(spelt.dictionary), 1)
                keys, uses = np.unique(row * width + spelt.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
                at = pa.array(keys // width)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(at) for c in columns], spelt.dictionary.take(pa.array(keys % width)).cast(pa.string()), pa.array(uses.astype(np.int64))],
                    names=[*columns, "token", "n"])

    plain = records.select(*columns, "tokens")
    return plain.mapInArrow(count, StructType([*plain.schema.fields[:-1], *StructType.fromDDL("token string, n long").fields]))


def document_tokens(most: int):
    """From `tokens` (token, n): of about `most` tokens at once how many rows hold each, and the number
    of rows with a NULL token."""
    import numpy as np
    import pyarrow as pa

    def count(batches):
        total, held = 0, []
        for whole in batches:
            total += whole.num_rows
            for first, n in slices(whole.column("tokens"), most):
                held.append(whole.column("tokens").slice(first, n))
                if sum(len(x.flatten()) for x in held) >= most:
                    yield counted(held)
                    held = []
        if held:
            yield counted(held)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([total], pa.int64())], names=["token", "n"])

    def counted(held):
        lists = pa.concat_arrays(held)
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        spelt = lists.flatten().dictionary_encode()
        width = max(len(spelt.dictionary), 1)
        keys = np.sort(row * width + spelt.indices.to_numpy(zero_copy_only=False))
        keys = keys[np.flatnonzero(np.diff(keys, prepend=-1))]
        return pa.RecordBatch.from_arrays(
            [spelt.dictionary.cast(pa.string()), pa.array(np.bincount(keys % width, minlength=len(spelt.dictionary)), pa.int64())], names=["token", "n"])

    return count


def spelt_bags(records: DataFrame) -> DataFrame:
    """`records` with their tokens in order and `spelling`, the md5 digest of these, blanks between."""
    import hashlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    columns = [c for c in records.columns if c != "tokens"]

    def spell(batches):
        for whole in batches:
            for first, n in slices(whole.column("tokens"), SLICE):
                batch = whole.slice(first, n)
                lists = batch.column("tokens")
                row = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                spelt = lists.flatten().dictionary_encode()
                order = pc.sort_indices(spelt.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
                rank = np.empty(len(order), dtype=np.int64)
                rank[order] = np.arange(len(order))
                width = max(len(order), 1)
                keys = np.sort(row * width + rank[spelt.indices.to_numpy(zero_copy_only=False)])
                tokens = _lists(row, spelt.dictionary.take(pa.array(order[keys % width])).cast(pa.string()), n, None)
                joined = pc.binary_join(tokens, " ")
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in columns], tokens, pa.array([hashlib.md5(x.as_buffer()).hexdigest() for x in joined], pa.string())],
                    names=[*columns, "tokens", "spelling"])

    return through(records, spell, StructType([*[records.schema[c] for c in [*columns, "tokens"]], *StructType.fromDDL("spelling string").fields]))


def _units(held, columns):
    import numpy as np
    import pyarrow as pa

    def units(batches):
        idf = held.value[1]
        for batch in batches:
            n = batch.num_rows
            row, code = rows_and_values(batch.column("codes"))
            _, uses = rows_and_values(batch.column("uses"))
            more, beyond = rows_and_values(batch.column("_code"))
            _, weights = rows_and_values(batch.column("_weight"))
            weight = np.concatenate([uses * idf[code], weights])
            row, code = np.concatenate([row, more]), np.concatenate([code, beyond]).astype(np.int64)
            order = np.lexsort((code, row))
            row, code, weight = row[order], code[order], weight[order]
            norm = np.sqrt(np.bincount(row, weight * weight, n))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], _lists(row, code, n, pa.int64()), _lists(row, weight / norm[row], n, pa.float64())],
                names=[*columns, "codes", "units"])

    return units


def rows_and_values(lists):
    """Of a column of lists each value's row, and the values; null lists are empty."""
    import numpy as np

    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy(zero_copy_only=False)


def postings(vectors: DataFrame, columns: list[str], cut: float = 0.0) -> DataFrame:
    """(token, unit, `columns`): a row a token of a vector, the token by its code. With a `cut` each
    vector leaves out its commonest tokens, up to a length of `cut`."""
    import numpy as np
    import pyarrow as pa

    def spread(batches):
        for whole in batches:
            for first, n in slices(whole.column("codes"), SLICE):
                batch = whole.slice(first, n)
                row, code = rows_and_values(batch.column("codes"))
                _, unit = rows_and_values(batch.column("units"))
                kept = _kept_tokens(row, unit, n, cut)
                at = pa.array(row[kept])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code[kept]), pa.array(unit[kept]), *[batch.column(c).take(at) for c in columns]],
                    names=["token", "unit", *columns])

    named = vectors.select("codes", "units", *columns)
    schema = StructType([*StructType.fromDDL("token long, unit double").fields, *named.schema.fields[2:]])
    return named.mapInArrow(spread, schema)


def dot_products(pairs: DataFrame, left: tuple[str, str], right: tuple[str, str], name: str) -> DataFrame:
    """`pairs` without the columns `left` and `right` (codes, units) and with `name`, the dot product;
    pairs that share no token drop out."""
    import numpy as np
    import pyarrow as pa

    columns = [c for c in pairs.columns if c not in (*left, *right)]

    def multiply(batches):
        for whole in batches:
            for first, n in slices(whole.column(left[0]), SLICE):
                batch = whole.slice(first, n)
                (row, a), (other, g) = (rows_and_values(batch.column(c)) for c in (left[0], right[0]))
                a, g = row << CODE_BITS | a, other << CODE_BITS | g
                shared, i, j = np.intersect1d(a, g, assume_unique=True, return_indices=True)
                row = shared >> CODE_BITS
                (_, u), (_, v) = (rows_and_values(batch.column(c)) for c in (left[1], right[1]))
                found = np.bincount(row, u[i] * v[j], n)
                at = pa.array(np.flatnonzero(np.bincount(row, minlength=n)))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(at) for c in columns], pa.array(found).take(at)], names=[*columns, name])

    kept = pairs.select(*columns, *left, *right)
    return kept.mapInArrow(tidy(multiply), StructType([*kept.schema.fields[: len(columns)], *StructType.fromDDL(f"{name} double").fields]))


def met(pairs: DataFrame, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Stored `pairs` with the columns of `left` and `right`, joined by the first and the second of `keys`.
    With few pairs only the rows that they name are shuffled."""
    if pairs.limit(HELD_PAIRS + 1).count() <= HELD_PAIRS:
        return left.join(F.broadcast(pairs), keys[0]).join(right.join(F.broadcast(pairs.select(*keys)), keys[1]), keys)
    return pairs.join(left, keys[0]).join(right, keys[1])


#: kept postings that a task takes of one side, rows that it multiplies at once, and the least tasks a side
BLOCK_POSTINGS, TILE, LEAST_BLOCKS = 1 << 22, 1 << 11, 4
#: a token goes into the dense part of a product if so many times its products fill a tile, as long as
#: there are not too many
DENSE, MOST_DENSE = 1000, 1 << 12
#: products a pair of rows from which whole tiles are multiplied, and cells a product up to which sums have
#: a cell each
FILLED, CELLS = 4, 8
#: bins that the tokens a vector drops may be long together, less than one: what shares no other token is in bin 0
DROPPED = 0.6


def cosine_bins(left: DataFrame, right: DataFrame, bins: int, key: str | None = None) -> DataFrame:
    """(bin, pairs) for bins from 1 up: how many pairs of a row of `left` and one of `right` (codes,
    units, n) have their dot product in a bin of 1/`bins`, a pair counted n x n times.

    Each vector drops its commonest tokens, up to a length of DROPPED bins. Both sides are dealt into
    blocks, and each pair of blocks is one task, which adds up the products of the kept tokens alone
    and bounds what is missing of each pair that may reach bin 1. Where this leaves one bin the pair is
    counted; the others, few as a rule, are sent and scored on their whole vectors. `key` tells a
    side's rows apart; without it both sides are numbered and stored.
    """
    if key is None:
        key = "_row"
        left, right = (settle(side.select("codes", "units", "n", F.monotonically_increasing_id().alias(key))) for side in (left, right))
    sides = [side.select(F.lit(own).alias("_left"), key, F.col("n").cast("bigint").alias("n"), "codes", "units") for own, side in ((True, left), (False, right))]
    kept = settle(_kept_parts(sides[0].unionByName(sides[1]), DROPPED / bins))
    sizes = dict(kept.groupBy("_left").agg(F.sum(F.size("codes"))).collect())
    blocks = [max(LEAST_BLOCKS, -(-(sizes.get(own) or 0) // BLOCK_POSTINGS)) for own in (True, False)]

    def dealt(of_left: bool, own: str, other: str, n_own: int, n_other: int) -> DataFrame:
        return kept.filter(F.col("_left") == of_left).select(
            F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
            *[F.col(c).alias(c) for c in (key, "n", "codes", "units", "dropped")])  # both sides come from one table

    a = dealt(True, "_a", "_g", *blocks).groupBy("_a", "_g")
    g = dealt(False, "_g", "_a", *reversed(blocks)).groupBy("_a", "_g")
    schema = StructType([
        *StructType.fromDDL("bin int, pairs bigint").fields,
        *[StructField(name, kept.schema[key].dataType) for name in ("_ka", "_kg")]])
    counted = settle(a.cogroup(g).applyInArrow(_count_bins(bins, key), schema))
    whole = [side.select(F.col(key).alias(k), F.col("codes").alias(f"codes{k}"), F.col("units").alias(f"units{k}")) for side, k in ((left, "_ka"), (right, "_kg"))]
    open_pairs = met(counted.filter("bin IS NULL").drop("bin"), *whole, ["_ka", "_kg"])
    scored = dot_products(open_pairs.select("pairs", "codes_ka", "units_ka", "codes_kg", "units_kg"),
                          ("codes_ka", "units_ka"), ("codes_kg", "units_kg"), "cosine")
    late = scored.select(F.floor(F.round(F.col("cosine") * bins, 7)).cast("int").alias("bin"), "pairs").filter("bin > 0")
    return counted.filter("bin > 0").select("bin", "pairs").unionByName(late).groupBy("bin").agg(F.sum("pairs").alias("pairs"))


def _kept_tokens(row, unit, n: int, cut: float):
    """Which postings stay when each of `n` vectors leaves out its commonest tokens, up to a length of `cut`."""
    import numpy as np

    if cut <= 0 or not len(row):
        return np.ones(len(row), dtype=bool)
    sums = np.cumsum(unit * unit)
    starts = np.searchsorted(row, np.arange(n))
    before = np.where(starts > 0, sums[np.maximum(starts - 1, 0)], 0.0)
    return sums - before[row] > cut * cut - 1e-12


def _kept_parts(vectors: DataFrame, cut: float) -> DataFrame:
    """`vectors` with only the kept tokens, and `dropped`, the sum of the others' squares."""
    import numpy as np
    import pyarrow as pa

    columns = [c for c in vectors.columns if c not in ("codes", "units")]

    def keep(batches):
        for whole in batches:
            for first, n in slices(whole.column("codes"), SLICE):
                batch = whole.slice(first, n)
                row, code = rows_and_values(batch.column("codes"))
                _, unit = rows_and_values(batch.column("units"))
                kept = _kept_tokens(row, unit, n, cut)
                dropped = np.bincount(row[~kept], unit[~kept] ** 2, n)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in columns], _lists(row[kept], code[kept], n, pa.int64()), _lists(row[kept], unit[kept], n, pa.float64()), pa.array(dropped, pa.float64())],
                    names=[*columns, "codes", "units", "dropped"])

    named = vectors.select(*columns, "codes", "units")
    return named.mapInArrow(tidy(keep), StructType([*named.schema.fields, *StructType.fromDDL("dropped double").fields]))


class _Side:
    """A block of kept vectors: entries by row, and what it takes to bound the products of dropped tokens."""

    def __init__(self, table, key):
        import numpy as np
        import pyarrow as pa

        self.row, self.code = rows_and_values(pa.concat_arrays(table["codes"].chunks))
        self.row = self.row.astype(np.int32)
        _, self.unit = rows_and_values(pa.concat_arrays(table["units"].chunks))
        self.n, self.key = table["n"].to_numpy().astype(float), table[key].combine_chunks()
        self.dropped = table["dropped"].to_numpy()
        self.sums = np.concatenate([[0.0], np.cumsum(self.unit * self.unit)])
        self.starts = np.searchsorted(self.row, np.arange(len(self.n), dtype=np.int32))
        self.places = self.row.astype(np.int64) << CODE_BITS
        self.places |= self.code

    def first(self, rows):
        """The commonest kept token; all dropped ones are commoner."""
        return self.code[self.starts[rows]]

    def below(self, rows, code):
        """At least the sum of squares over the tokens commoner than `code`."""
        import numpy as np

        at, start = np.searchsorted(self.places, rows << CODE_BITS | code), self.starts[rows]
        return self.dropped[rows] + np.where(at > start, self.sums[at] - self.sums[start] + 1e-9, 0.0)


def _count_bins(bins: int, key: str):
    import numpy as np
    import pyarrow as pa

    def tiles(row, token, unit, n, dense):
        """Each tile's first row, rows, entries by token, and dense part."""
        width = int(dense.max(initial=-1)) + 1
        for first in range(0, n, TILE):
            lo, hi = np.searchsorted(row, (first, first + TILE))
            r, t, u = row[lo:hi] - first, token[lo:hi], unit[lo:hi]
            rows = min(TILE, n - first)
            full = np.zeros((rows, width))
            thick = dense[t] >= 0
            full[r[thick], dense[t[thick]]] = u[thick]
            r, t, u = r[~thick], t[~thick], u[~thick]
            order = np.argsort(t, kind="stable")
            yield first, rows, (r[order], t[order], u[order]), full

    def expanded(one, two, starts, counts, at):
        """Of the entries `at` of `one` with all entries of `two` of their tokens: rows, rows, products."""
        (r, t, u), (s, _, v) = one, two
        many = counts[t[at]]
        rep = np.repeat(at, many)
        places = np.arange(len(rep)) - np.repeat(np.cumsum(many) - many - starts[t[at]], many)
        return r[rep], s[places], u[rep] * v[places]

    def products(shape, one, two, starts, counts):
        """The products over the tokens that aren't dense, by pairs of entries."""
        out = np.zeros(shape[0] * shape[1])
        met = counts[one[1]]
        at = np.flatnonzero(met)
        ends = np.cumsum(met[at])
        first = 0
        while first < len(at):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + 4 * SLICE, side="right")))
            r, s, x = expanded(one, two, starts, counts, at[first:last])
            out += np.bincount(r * shape[1] + s, x, len(out))
            first = last
        return out.reshape(shape)

    def filled(a, g, n_a, n_g, work, least):
        """(rows, rows, sums) of the pairs above `least`, tile by tile."""
        thick = np.flatnonzero(work * DENSE > float(n_a) * n_g)
        thick = thick[np.argsort(-work[thick], kind="stable")[:MOST_DENSE]]
        dense = np.full(len(work), -1)
        dense[thick] = np.arange(len(thick))
        for start, columns, entries, full_g in tiles(*g, n_g, dense):
            counts = np.bincount(entries[1], minlength=len(work))
            starts = np.cumsum(counts) - counts
            for first, rows, own, full in tiles(*a, n_a, dense):
                sums = products((rows, columns), own, entries, starts, counts)
                sums += full @ full_g.T
                i, j = np.nonzero(sums > least)
                yield first + i, start + j, sums[i, j]

    def scattered(a, g, n_g, tokens, least):
        """The same, rows of `a` at a time that have few products, added up by pair."""
        order = np.argsort(g[1], kind="stable")
        by_token = tuple(x[order] for x in g)
        counts = np.bincount(g[1], minlength=tokens)
        starts = np.cumsum(counts) - counts
        ends = np.cumsum(counts[a[1]])
        rows = np.flatnonzero(np.diff(a[0], append=-1))  # each row's last entry
        done = ends[rows]
        first = 0
        while first < len(rows):
            lo = rows[first - 1] + 1 if first else 0
            last = max(first + 1, int(np.searchsorted(done, (ends[lo - 1] if lo else 0) + SLICE, side="right")))
            r, s, x = expanded(a, by_token, starts, counts, np.arange(lo, rows[last - 1] + 1))
            base = a[0][lo]
            cell = np.multiply(r - base, n_g, dtype=np.int64) + s
            cells = int(a[0][rows[last - 1]] - base + 1) * n_g
            if cells <= CELLS * len(cell):
                sums = np.bincount(cell, x, cells)
                cell = np.flatnonzero(sums > least)
                yield cell // n_g + base, cell % n_g, sums[cell]
            elif len(cell):
                order = np.argsort(cell, kind="stable")
                cell = cell[order]
                begins = np.flatnonzero(np.diff(cell, prepend=-1))
                sums = np.add.reduceat(x[order], begins)
                high = sums > least
                cell = cell[begins[high]]
                yield cell // n_g + base, cell % n_g, sums[high]
            first = last

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return counted(left, right)
        finally:
            give_back()

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        totals, still_open = [0] * (bins + 1), []
        if left.num_rows and right.num_rows:
            a, g = _Side(left, key), _Side(right, key)
            n_a, n_g = len(a.n), len(g.n)
            spelt = pa.concat_arrays([pa.array(a.code), pa.array(g.code)]).dictionary_encode()
            token, tokens = spelt.indices.to_numpy(), len(spelt.dictionary)
            token_a, token_g = token[: len(a.code)], token[len(a.code):]
            uses_a, uses_g = np.bincount(token_a, minlength=tokens), np.bincount(token_g, minlength=tokens)
            kept_a, kept_g = uses_g[token_a] > 0, uses_a[token_g] > 0
            entries_a, entries_g = (tuple(x[kept] for x in (side.row, codes, side.unit)) for side, codes, kept in ((a, token_a, kept_a), (g, token_g, kept_g)))
            del spelt, token, token_a, token_g, kept_a, kept_g
            a.row = g.row = None
            work = uses_a.astype(float) * uses_g
            most = np.sqrt(max(a.dropped.max(), g.dropped.max()))
            least = (1 - 1e-6) / bins - most - 1e-9
            if work.sum() > FILLED * float(n_a) * n_g:
                found = filled(entries_a, entries_g, n_a, n_g, work, max(least, 0.0))
            else:
                found = scattered(entries_a, entries_g, n_g, tokens, max(least, 0.0))
            for i, j, sums in found:
                code = np.maximum(a.first(i), g.first(j))
                missing = np.sqrt(a.below(i, code) * g.below(j, code)) * (1 + 1e-6)
                low = np.floor(np.round(sums * bins, 7)).astype(np.int64)
                high = np.minimum(np.floor(np.round((sums + missing) * bins, 7)).astype(np.int64), bins)
                n = a.n[i] * g.n[j]
                sure = low == high
                for k, x in enumerate(np.bincount(low[sure], n[sure], bins + 1)):
                    totals[k] += int(x)
                if not sure.all():
                    still_open.append((i[~sure], j[~sure], n[~sure].astype(np.int64)))
        bin_of = [k for k in range(1, bins + 1) if totals[k]]
        i, j, n = (np.concatenate(x) for x in zip(*still_open)) if still_open else (np.zeros(0, dtype=np.int64),) * 3
        kind = left[key].type
        return pa.table({
            "bin": pa.array([*bin_of, *[None] * len(n)], pa.int32()),
            "pairs": pa.array([*[totals[k] for k in bin_of], *n.tolist()], pa.int64()),
            "_ka": pa.concat_arrays([pa.nulls(len(bin_of), kind), a.key.take(pa.array(i))] if len(n) else [pa.nulls(len(bin_of), kind)]),
            "_kg": pa.concat_arrays([pa.nulls(len(bin_of), kind), g.key.take(pa.array(j))] if len(n) else [pa.nulls(len(bin_of), kind)]),
        })

    return count
