"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.staging import Staging


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("node").agg(F.min("other").alias("least"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
            )
        ).alias("pair")
    ).select("pair.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node around it."""
    pairs = _both_ways(edges)
    least = _smallest(pairs).select("node", F.least("node", "least").alias("least"))
    return (
        pairs.join(least, "node")
        .where(F.col("other") > F.col("node"))
        .select(F.col("other").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties every smaller neighbour of a node, and the node, to the smallest of them."""
    pairs = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    least = _smallest(pairs)
    moved = (
        pairs.join(least, "node")
        .where(F.col("other") != F.col("least"))
        .select(F.col("other").alias("a"), F.col("least").alias("b"))
    )
    return moved.union(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """`node`, `component` (smallest reachable node) for every node of `edges` (`a`, `b`).

    Every round only groups and joins, is written to the shared folder, and
    halves the length of the longest chain; a node with very many neighbours is
    a skewed join side, which adaptive execution splits. Self-loops and repeated
    edges are allowed; no edges give no rows.
    """
    loops = edges.where("a = b").select("a").distinct()
    edges = staging.save(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = _state(edges)
    while True:
        edges = staging.save(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = loops.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return nodes.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
