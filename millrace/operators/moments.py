"""Means, second moments and covariance of array columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import stage

MAX_WIDTH = 4096  # a width x width matrix of doubles must fit the driver


def column_means(df: DataFrame, features: str = "features") -> DataFrame:
    """(pos, mean), one row per position. Each task adds up whole vectors; rows with a NULL array or
    element are left out."""
    mean = whole_rows(df, features).agg(Summarizer.mean(array_to_vector(F.col(features))).alias("mean"))
    return mean.filter("mean is not null").select(F.posexplode(vector_to_array("mean")).alias("pos", "mean"))


def mean_vector(df: DataFrame, features: str = "features") -> list[float]:
    """The means on the driver: as many numbers as the vectors are wide."""
    first = df.select(Summarizer.mean(array_to_vector(F.col(features))).alias("mean")).first()
    return [] if first["mean"] is None else first["mean"].toArray().tolist()


def whole_rows(df: DataFrame, features: str) -> DataFrame:
    """The rows whose array is there and holds no NULL."""
    return df.filter(F.col(features).isNotNull() & ~F.exists(features, lambda x: x.isNull()))


def products(df: DataFrame, columns: list[str], shift=None) -> DataFrame:
    """(i, j, total), i <= j: sums of products over all rows of the concatenated
    `columns` (arrays of doubles, of one width), after taking off `shift`.

    Rows with a NULL array or element have no second moments and are left out. Arrays of several
    widths, or wider than MAX_WIDTH, are refused: a task says which widths it met beside its sums,
    so the rows are read once.

    A task multiplies its batches as matrices and sends its triangle as one row. Triangles
    are added in two steps, first in about as many groups as a group has triangles, so no
    task adds up those of all others; the last one adds the square root of their number, each
    of at most MAX_WIDTH ** 2 / 2 numbers.
    """
    offset = 0.0 if shift is None else np.asarray(shift, dtype=float)
    joined = whole_rows(df.select(F.concat(*columns).alias("_z")), "_z")
    groups = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def multiply(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        total, widths = None, set()
        for batch in batches:
            if not batch.num_rows:
                continue
            widths |= set(pc.unique(pc.list_value_length(batch.column(0))).to_pylist())
            if len(widths) > 1 or max(widths) > MAX_WIDTH:
                continue
            width = max(widths)
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            z = flat.astype(float).reshape(batch.num_rows, width) - offset
            total = z.T @ z + (0.0 if total is None else total)
        part = None if total is None else total[np.triu_indices(len(total))]
        yield from (
            pa.RecordBatch.from_arrays([pa.array([w], pa.int32()), pa.array([part], pa.list_(pa.float64()))], names=["width", "part"])
            for w in sorted(widths))

    sent = stage(joined.mapInArrow(multiply, "width int, part array<double>"), "triangles")
    met = sorted(r["width"] for r in sent.select("width").distinct().limit(2).collect())
    if len(met) > 1:
        raise ValueError(f"vectors of {met[0]} to {met[-1]} places")
    width = met[0] if met else 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors are wider than {MAX_WIDTH}")
    size = width * (width + 1) // 2

    def add(batches):
        import numpy as np
        import pyarrow as pa

        total, seen = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total += batch.column(0).flatten().to_numpy().reshape(batch.num_rows, size).sum(axis=0)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["part"])

    schema = "part array<double>"
    parts = sent.select("part").repartition(groups).mapInArrow(add, schema)
    one = parts.repartition(1).mapInArrow(add, schema)
    return one.select(F.posexplode("part").alias("k", "total")).select(*_pair_of(F.col("k"), width), "total")


def _pair_of(k: Column, width: int) -> tuple[Column, Column]:
    """Row i and column j, i <= j, of the k-th number of an upper triangle written row by row: row i
    begins at i * width - i (i - 1) / 2. The root is at most one row off."""
    k = k.cast("bigint")

    def begin(i: Column) -> Column:
        return i * width - (i * (i - 1) / 2).cast("bigint")

    near = F.floor((2 * width + 1 - F.sqrt(F.lit(float((2 * width + 1) ** 2)) - 8 * k)) / 2).cast("bigint")
    i = near + F.when(begin(near + 1) <= k, 1).when(begin(near) > k, -1).otherwise(0)
    return i.cast("int").alias("i"), (k - begin(i) + i).cast("int").alias("j")


def covariance(df: DataFrame, features: str = "features") -> DataFrame:
    """(i, j, cov) for every position pair, divided by the number of rows. The mean is
    taken off first, so large means do not cancel digits."""
    df = whole_rows(df, features)
    rows = df.agg(F.count(F.lit(1))).scalar()
    upper = products(df, [features], mean_vector(df, features)).withColumn(
        "cov", F.col("total") / rows
    )
    mirrored = upper.filter("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "cov")
    return upper.select("i", "j", "cov").unionByName(mirrored)


@dataclass(frozen=True)
class Moments:
    """Everything least squares needs to know of the rows: count, X'X, X'y, y'y."""

    rows: int
    xx: np.ndarray
    xy: np.ndarray
    yy: float


def regression_moments(df: DataFrame, intercept: bool = False) -> Moments:
    """One pass over (label, features); with `intercept` a constant 1 is appended."""
    tail = F.array(F.lit(1.0), F.col("label"))
    stacked = df.select("features", tail.alias("_tail"))
    table = products(stacked, ["features", "_tail"]).toPandas()
    if table.empty:
        raise ValueError("no rows to fit")
    size = int(table["j"].max()) + 1
    full = np.zeros((size, size))
    full[table["i"], table["j"]] = table["total"]
    full = np.triu(full) + np.triu(full, 1).T
    one, label = size - 2, size - 1
    keep = list(range(size - 1 if intercept else size - 2))
    return Moments(
        rows=int(round(full[one, one])),
        xx=full[np.ix_(keep, keep)],
        xy=full[keep, label],
        yy=float(full[label, label]),
    )
