"""Connected components by alternating large-star and small-star steps.

Both steps are a minimum by node (combined before the shuffle) joined back to the edges, so a node with very many
neighbours is split by the join and never gathered.  Every step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roompulse.llm.tables import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours hang on its least neighbour, itself included."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours hang on the least of those."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    neighbours = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return neighbours.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component: its least reachable node) for the nodes of edges (u, v) that are not their own component."""
    stars, before = edges.where(F.col("u") != F.col("v")).select("u", "v"), None
    while True:
        stars = stored(small_star(stored(large_star(stars), "large-star")), "small-star")
        seen = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = seen
