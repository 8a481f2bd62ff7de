"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node reachable) for every node with a larger-to-smaller path.

    ``edges``: ``a, b``. Large-star hangs every larger neighbour of a node on
    the node's smallest neighbour; small-star does the same with the smaller
    ones. Both keep components whole and edges shrink to stars in
    O(log^2 n) rounds. Each round's edges are written to the shared folder, so
    lineage stays short; only a count and a checksum reach the driver. A
    minimum is one pre-aggregated row per node, and the join back may split a hub."""
    now = written(_oriented(edges), "edges")
    was = None
    while (mark := _mark(now)) != was and mark[0]:
        was = mark
        now = written(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(low.select("a", F.col("m").alias("b"))).distinct()
