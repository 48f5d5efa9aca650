"""Connected components of a link table: union-find as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoner.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Large-star and small-star rounds: each node hands its larger, then its smaller neighbours to the smallest
    one it knows. Rounds grow with the logarithm of the longest chain. Minima are combined before the
    shuffle and no neighbour list is gathered, so a node with very many links needs no single task; its
    rows can be split in the join. Each round is written to the checkpoint folder.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = materialize(large.where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        down = large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        after = materialize(down.union(low.select("u", F.col("low").alias("v"))).distinct())
        # done when every node has one link and no target has one itself
        ends = after.select(F.col("u").alias("node"), F.lit(1).alias("links"), F.lit(0).alias("aimed"))
        ends = ends.union(after.select("v", F.lit(0), F.lit(1))).groupBy("node")
        ends = ends.agg(F.sum("links").alias("links"), F.max("aimed").alias("aimed"))
        edges = after
        if ends.where("links > 1 or links = 1 and aimed = 1").isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
