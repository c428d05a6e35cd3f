"""Equi-joins that hold up when a few keys carry most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import settle

# A key is hot when it holds more than 1/PIECES of all fact rows, so there are fewer
# than PIECES hot keys whatever the data: that is the bound on what gets broadcast.
PIECES = 1024


def hot_keys(sizes: DataFrame, on: list[str], pieces: int = PIECES) -> DataFrame:
    """`on`, `_spread` for keys holding more than 1/pieces of the rows counted in
    `sizes` (columns `on`, `n`); fewer than `pieces` rows."""
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.filter(F.col("n") * pieces > total).select(
        *on, F.ceil(F.col("n") * pieces / total).cast("int").alias("_spread")
    )


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    spread_by: list[str],
    sizes: DataFrame | None = None,
    how: str = "inner",
    pieces: int = PIECES,
) -> DataFrame:
    """Join `fact` to `dim`, dealing the fact rows of each hot key over several
    shuffle keys and repeating only the matching `dim` rows.

    `spread_by` names fact columns that tell the rows of one key apart; a hash of them
    picks the piece, so a re-run task deals the same way. `sizes` gives fact rows per
    key as column `n` where the caller has them at hand (a stored table: it is read more
    than once); without it they are counted first and written. `how` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if sizes is None:
        sizes = settle(fact.groupBy(*on).agg(F.count(F.lit(1)).alias("n")))
    hot = F.broadcast(hot_keys(sizes, on, pieces))
    spread = F.coalesce(F.col("_spread"), F.lit(1))
    dealt = (
        fact.join(hot, on, "left")
        .withColumn("_piece", F.pmod(F.xxhash64(*spread_by), spread).cast("int"))
        .drop("_spread")
    )
    repeated = (
        dim.join(hot, on, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), spread - 1)))
        .drop("_spread")
    )
    return dealt.join(repeated, [*on, "_piece"], how).drop("_piece")
