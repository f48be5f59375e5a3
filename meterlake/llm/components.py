"""Connected components of a large graph, and only joins and aggregates to find them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.session import stored


def _rooted(parents: DataFrame) -> DataFrame:
    """(u, v) with v followed until it has no parent; paths halve with every step."""
    while True:
        above = parents.select(F.col("u").alias("v"), F.col("v").alias("w"))
        parents = stored(
            parents.join(above, "v", "left").select(
                "u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved")
            ),
            "roots",
        )
        if parents.where("moved").isEmpty():
            return parents.select("u", "v")


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for each node u that is not the least of its component, which is v.

    `edges` has whole numbers u > v; repeated ones don't matter, an empty table gives
    none. In each round every node points to its least neighbour, paths are followed to
    their roots, and the edges between different roots go on. Every node with a lesser
    neighbour leaves, so the rounds grow with the logarithm of the nodes. All tables
    are written before they are joined, so that the joins on crowded nodes can split.
    """
    edges = stored(edges.select("u", "v").distinct(), "edges")
    result = None
    while not edges.isEmpty():
        parents = stored(edges.groupBy("u").agg(F.min("v").alias("v")), "parents")
        roots = _rooted(parents)
        above = roots.select(F.col("u").alias("v"), F.col("v").alias("root"))
        if result is None:
            result = roots
        else:
            moved = result.join(above, "v", "left").select(
                "u", F.coalesce("root", "v").alias("v")
            )
            result = stored(moved.unionByName(roots), "labels")
        below = roots.select("u", F.col("v").alias("a"))
        pairs = (
            edges.join(below, "u")
            .join(above, "v", "left")
            .select("a", F.coalesce("root", "v").alias("b"))
            .where("a <> b")
        )
        edges = stored(
            pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
            "edges",
        )
    if result is None:
        return edges
    return result
