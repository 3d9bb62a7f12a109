"""Connected components of a large graph by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.workspace import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the smallest node next to it."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("a"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge; ``root`` is the smallest node it reaches.

    ``edges`` has two columns of one ordered type; direction, repeats and loops do not matter, edges
    with a null are no edges. Each round keeps one row per edge and never gathers a node's
    neighbours; its result is written to the shared folder, which cuts the lineage. The rounds end
    when the edges stay the same, after about log n of them. Only their digest reaches the driver.
    """
    a, b = edges.columns[:2]
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    edges = written(edges, "edges")
    before, now = None, _state(edges)
    while now != before:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, now = now, _state(edges)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())
