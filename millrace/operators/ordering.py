"""Row numbers, running totals, top rows and repeatable splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from millrace.functions.hashing import unit_interval
from millrace.session import settle

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in the low 33 bits


def with_ordinal(
    df: DataFrame, order: list[str], name: str = "ordinal", partitions: int | None = None
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given total order.

    One range shuffle lays the rows out in sorted blocks, which are written once; the
    number is then the rows in earlier blocks plus the place within the block. The
    block table has one row per partition, so broadcasting it is bounded.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    laid = settle(
        ranged.sortWithinPartitions(*order).withColumn("_mark", F.monotonically_increasing_id())
    )
    laid = laid.select(
        *df.columns,
        F.shiftrightunsigned("_mark", _ROW_BITS).alias("_block"),
        F.col("_mark").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
    )
    before = _earlier_blocks(laid.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")), ["_n"])
    return (
        laid.join(F.broadcast(before), "_block")
        .withColumn(name, F.col("_n_before") + F.col("_place"))
        .select(*df.columns, name)
    )


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Add running sums over the whole table in the given total order.

    Rows go into range blocks on the full order, ties included, so no block grows with
    a hot value. Each sorted block is summed as it is written, and shifted by the earlier
    blocks when it is read: one range shuffle in all. NULLs add nothing.
    """
    columns = df.columns
    whole = {"tinyint", "smallint", "int", "bigint"}
    inputs = df.select(*columns, *[value.alias(f"_v_{name}") for name, value in sums.items()])
    kinds = {name: "bigint" if inputs.schema[f"_v_{name}"].dataType.simpleString() in whole else "double" for name in sums}
    inputs = inputs.select(*columns, *[
        F.coalesce(F.col(f"_v_{name}").cast(kind), F.lit(0).cast(kind)).alias(f"_v_{name}") for name, kind in kinds.items()])
    ranged = inputs.repartitionByRange(*order).sortWithinPartitions(*order)
    marks = "_block bigint, _place bigint"
    schema = StructType([*ranged.schema.fields, *StructType.fromDDL(marks).fields])
    laid = settle(ranged.mapInArrow(_summed_up(len(columns)), schema))
    ends = laid.groupBy("_block").agg(*[F.max_by(f"_v_{name}", "_place").alias(f"_t_{name}") for name in sums])
    before = _earlier_blocks(ends, [f"_t_{name}" for name in sums])
    return laid.join(F.broadcast(before), "_block").select(
        *columns, *[(F.col(f"_v_{name}") + F.col(f"_t_{name}_before")).alias(name) for name in sums])


def _summed_up(first: int):
    """Running sums of the columns from `first` on, over a task's batches, with block and place."""

    def add(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        block, place, carried = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns[first:]]
            sums = [np.cumsum(v) + c for v, c in zip(values, carried or [0] * len(values), strict=True)]
            carried = [s[-1] for s in sums]
            places = np.arange(place, place + batch.num_rows)
            place += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:first], *map(pa.array, sums), pa.array(np.full(batch.num_rows, block)), pa.array(places)],
                names=[*batch.schema.names, "_block", "_place"])

    return add


def _earlier_blocks(totals: DataFrame, names: list[str]) -> DataFrame:
    """Sums over all earlier blocks; one row per block, so one window holds them."""
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_block",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in names],
    )


def top_rows(df: DataFrame, by: str, ties: list[str], limit: int) -> DataFrame:
    """The `limit` rows with the largest `by`; ties go by the tie columns."""
    return df.orderBy(F.desc(by), *ties).limit(limit)


def key_split(df: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Add `split`, naming the part each row falls in.

    The part follows from the row's key alone, so it does not move with partitioning
    or on a re-run; rows with equal keys stay together.
    """
    total = float(sum(shares.values()))
    point = unit_interval(*[F.col(key) for key in keys])
    reached, choice = 0.0, None
    names = list(shares)
    for name in names[:-1]:
        reached += shares[name]
        bound = point < F.lit(reached / total)
        choice = F.when(bound, name) if choice is None else choice.when(bound, name)
    last = F.lit(names[-1])
    return df.withColumn("split", last if choice is None else choice.otherwise(last))


def with_share(counts: DataFrame, count: str, name: str = "share") -> DataFrame:
    """Each row's count over the sum of all counts, by a one-row subquery. The counts are
    written first, so that both uses share one pass over what they count."""
    counts = settle(counts)
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(name, F.col(count) / total)


def bottom_sample(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The `size` rows whose keys hash lowest, of equal hashes the lowest keys: the same sample however
    the rows are partitioned. Every task keeps its own lowest, so what meets is bounded by
    tasks x size; `size` is for samples that a task can hold."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    return df.withColumn("_digest", digest).orderBy("_digest", *keys).limit(size).drop("_digest")


def table_digest(df: DataFrame) -> DataFrame:
    """(rows, first, second): the number of rows and the sums of two independent hashes of them, which
    don't depend on their order. Columns are taken by name; one pass, and a row a task to add."""
    names = sorted(df.columns)
    whole = F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})
    one = F.xxhash64(*[F.col(f"`{n}`") for n in names], whole)
    two = F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.select(one.cast("decimal(38,0)").alias("a"), two.alias("b")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("string").alias("first"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("string").alias("second"),
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables of the same columns hold the same rows, duplicates counted, by their digests:
    one pass each, no shuffle of rows."""
    if sorted(left.columns) != sorted(right.columns):
        return False
    kinds = {f.name: f.dataType for f in left.schema.fields}
    right = right.select(*[F.col(f"`{n}`").cast(kinds[n]).alias(n) for n in right.columns])
    return table_digest(left).first() == table_digest(right).first()
