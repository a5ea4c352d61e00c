"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volcohort.llm.storage import drop, stage

def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and itself: the larger ones (large), or the smaller ones."""
    both = edges if not large else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node in links (a, b), long; component is the smallest node. No node: no row."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "edges")
    settled = False
    while not settled:  # the rounds grow with the logarithm of the longest path
        after = stage(_star(_star(edges, large=True), large=False), "edges")
        # Stars alone remain once no node has two smaller neighbours and no centre has a smaller one.
        many = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        chain = after.select(F.col("v").alias("u")).join(after.select("u"), "u", "left_semi").select("u")
        drop(edges)
        edges = after
        settled = many.union(chain).isEmpty()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
