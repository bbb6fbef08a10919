"""Connected components by alternating large-star / small-star contraction."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.session import cut_lineage


def _large_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    both = edges.select(*keys, "u", "v").union(
        edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.first("u")).alias("_m"))
    return (both.where(F.col("v") > F.col("u")).join(low, [*keys, "u"])
            .select(*keys, F.col("v").alias("u"), F.col("_m").alias("v")))


def _small_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    down = edges.select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy(*keys, "u").agg(F.min("v").alias("_m"))
    moved = down.join(low, [*keys, "u"]).where(F.col("v") != F.col("_m")).select(
        *keys, F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.union(low.select(*keys, "u", F.col("_m").alias("v")))


def connected_components(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, node, component) with the lowest node of each component as label.

    ``edges`` has integer columns u, v; components never cross ``keys``.  Nodes
    without an edge to another node are not listed.  Every round is joins with
    one row per node on one side, which adaptive execution can split on hubs.
    """
    keys = list(keys)
    edges = cut_lineage(edges.where(F.col("u") != F.col("v")).select(*keys, "u", "v").distinct())
    seen = None
    while True:
        edges = cut_lineage(_small_star(
            _large_star(edges, keys).where(F.col("u") != F.col("v")).distinct(), keys).distinct())
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    nodes = edges.select(*keys, F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(*keys, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots).distinct()
