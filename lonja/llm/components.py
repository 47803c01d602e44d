"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two aggregates and joins over the edges; no component is gathered anywhere. A hub with very many
edges meets one row in the join, so Spark can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Of edges u > v: every node's larger neighbours are joined to the smallest of the node and its neighbours."""
    pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    above = pairs.where("v > u").join(lowest, "u")
    return above.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges u > v: every node and its smaller neighbours are joined to the smallest of them."""
    joined = edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")
    u = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return joined.select(u.alias("u"), F.col("m").alias("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node has one smaller neighbour or none, and that one has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return roles.where("up > 1 OR (up = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge, root being the smallest node it is connected with.

    `edges` has long columns u and v in any direction; loops and repeated edges are allowed. Each round is
    written to the shared folder, and the rounds end when the edges are stars.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = written(ordered.distinct(), "edges")
    while not _settled(now):
        last, now = now, written(_small_star(_large_star(now)), "edges")
        discard(last)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
