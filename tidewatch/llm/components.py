"""Connected components of a link table, distributed, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where(F.col("b") > F.col("a")).join(low, "a").where(F.col("low") != F.col("b")).select(
        F.col("low").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these neighbours."""
    low = edges.groupBy("b").agg(F.min("a").alias("low"))
    up = edges.join(low, "b")
    moved = up.where(F.col("a") != F.col("low")).select(F.col("low").alias("a"), F.col("a").alias("b"))
    return moved.union(low.select(F.col("low").alias("a"), "b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; ``edges`` is (a, b) with a < b, both long.

    component is the smallest node reachable. The rounds end when no link changes, which takes a
    number of rounds about the logarithm of the longest chain. Every round works on minima per node
    (combined before the shuffle) and equi-joins, so no neighbourhood is gathered in one place.
    """
    edges = cut_lineage(edges)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        edges = cut_lineage(_small_star(_large_star(edges)))
    low = edges.groupBy("b").agg(F.min("a").alias("component"))
    members = low.select(F.col("b").alias("node"), "component")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return members.union(roots)
