"""Connected components by alternating large and small stars, on stored edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours are tied to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # the least neighbour is found by a partial aggregation, so a hub is no hot task
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.join(least, "u")
    if large:
        tied = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        smaller = tied.where("v < u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.where("m < u").select("u", F.col("m").alias("v"))
        tied = smaller.unionByName(own)
    return tied.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (u, v); the component is its least node.

    It ends when the edges are stars: every node has one edge, to a node that has none.
    Nulls and loops are dropped.
    """
    state = stored(edges.select("u", "v").where("u <> v").distinct(), "components")
    while True:
        n, nodes = state.agg(F.count("*"), F.count_distinct("u")).first()
        tops = state.select(F.col("v").alias("u")).distinct()
        if n == nodes and state.join(tops, "u", "left_semi").isEmpty() and state.where("u < v").isEmpty():
            break
        state = stored(_star(_star(state, large=True), large=False), "components")
    found = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots)
