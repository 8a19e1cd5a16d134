"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie neighbours of a node to the least node near it: its larger neighbours, or its smaller
    ones and itself. Minima are aggregated before the shuffle; no neighbour list is built."""
    near = _both_ways(edges) if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = near.join(least, "a")
    if larger:
        out = tied.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the root is the least node reachable.

    Each round writes its edges to the shared folder, so no lineage grows and a lost executor
    costs a re-read. The rounds end when every node hangs directly on its root."""
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        nxt = materialize(_star(_star(now, True), False), "edges")
        same = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() == now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now = nxt
        if same:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
