"""Connected components of a link table, by alternating large-star and small-star steps.

No node's links are gathered in one place: each step is a minimum by node (summed up before the
shuffle) and a join on the node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of u is linked to the least of u and its neighbours.
    Small star: the same for the smaller neighbours and u itself."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    if large:
        near = edges.unionByName(back)
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        linked = near.join(least, "a").where(F.col("b") > F.col("a")).select("b", "m")
    else:
        near = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = edges.select(near.alias("x")).select("x.a", "x.b")
        least = near.groupBy("a").agg(F.min("b").alias("m"))
        linked = near.join(least, "a").select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
    return linked.where(F.col("b") != F.col("m")).select(F.col("m").alias("a"), "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the component's least
    node. An empty table gives an empty one."""
    edges = stored(links.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    before = None
    while True:
        edges = stored(_star(_star(edges, True), False))
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    leaves = edges.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return leaves.unionByName(roots)
