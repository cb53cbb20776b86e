"""Connected components of an edge list (alternating large-star and small-star).

Each step is a grouped minimum and a join back on the node. The minima are
written out first, so both join sides are plain exchanges and the adaptive
planner can split a node that holds a large share of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import written


def _star(edges: DataFrame, large: bool, step: str) -> DataFrame:
    """edges (u, v). Large: each neighbour above u goes to the least of u and its
    neighbours. Small: u > v; u and all its neighbours go to its least one."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")), f"{step}-least")
    kept = both.where("v > u") if large else both
    moved = kept.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved if large else moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Every u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the least node of each component, for all nodes that have
    an edge and are not that least node themselves. ``edges`` has two columns u, v;
    self-loops, repeated edges and either direction are fine."""
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), f"{name}-edges")
    while not _is_done(edges):
        edges = written(_star(written(_star(edges, True, name), f"{name}-large"), False, name), f"{name}-small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
