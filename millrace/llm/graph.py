"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of edges (a, b) the smallest node that it reaches.

    Large-star and small-star steps in turn: every node links its larger neighbours, then its
    smaller ones, to the smallest. Each step is one grouping that keeps a minimum per node and a
    join on the node, so a node with very many neighbours makes no list; the number of rounds
    grows with the logarithm of the longest path.
    """
    now = stage(_ordered(edges.select("a", "b")), "component-edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _ordered(_starred(both).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _starred(down)
        after = stage(_ordered(small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            small.select("a", F.col("low").alias("b")))), "component-edges")
        if _print(after) == _print(now):
            break
        now = after
    nodes = after.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = after.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, its smaller node first, without loops."""
    return (
        edges.filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _starred(edges: DataFrame) -> DataFrame:
    """The edges with `low`, the smallest of a and its neighbours b."""
    low = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return edges.join(low, "a")


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 40) - 1))).first())
