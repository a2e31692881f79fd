"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the (u, v) edges; root is the smallest node
    reachable.  Each round is written to the shared folder; the number of rounds
    grows with the logarithm of the longest path.  Self-loops add nothing."""
    now = stage(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now)), "edges")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(nodes.select("root", "root").distinct())
