"""Diverse picks per cluster and outlier rules."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.pairwise import mean_distances
from trajlake.session import cut_lineage


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda t, s: t + s))


def select_maximin(vectors: DataFrame, n: int, include_noise: bool = False) -> DataFrame:
    """(id, cluster, selection_rank): farthest-point picks in every cluster.

    The first pick is nearest to the centroid, each further one maximises its
    distance to the picks so far; the lowest id wins ties.  All clusters move
    together, one aggregate per round; only the picks travel to the points.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    points = cut_lineage((vectors if include_noise else vectors.where(F.col("cluster") != -1))
                         .select("id", "cluster", "features"))
    dims = points.agg(F.max(F.size("features"))).first()[0]
    if dims is None:
        raise ValueError("every structure is noise; include noise or change the clustering")
    centers = points.groupBy("cluster").agg(
        F.array(*[F.avg(F.col("features")[i]) for i in range(dims)]).alias("_c"))
    near = F.struct(_distance(F.col("features"), F.col("_c")), F.col("id"))
    picks = points.join(centers, "cluster").groupBy("cluster").agg(
        F.min_by(F.struct("id", "features"), near).alias("p")).select(
        "cluster", F.col("p.id").alias("id"), F.col("p.features").alias("features"), F.lit(0).alias("selection_rank"))
    picks = cut_lineage(picks)
    for rank in range(1, n):
        # at most n picks per cluster
        so_far = picks.groupBy("cluster").agg(F.collect_list(F.struct("id", "features")).alias("_p"))
        rest = points.join(so_far, "cluster").where(~F.exists("_p", lambda p: p["id"] == F.col("id")))
        gap = F.array_min(F.transform("_p", lambda p: _distance(F.col("features"), p["features"])))
        best = rest.groupBy("cluster").agg(
            F.max_by(F.struct("id", "features"), F.struct(gap, -F.col("id"))).alias("p"))
        fresh = cut_lineage(best.select("cluster", F.col("p.id").alias("id"), F.col("p.features").alias("features"),
                                        F.lit(rank).alias("selection_rank")))
        if fresh.isEmpty():
            break
        picks = cut_lineage(picks.unionByName(fresh))
    return picks.select("id", "cluster", "selection_rank")


def zscore_outliers(rows: DataFrame, columns: Sequence[str], threshold: float = 2.0) -> DataFrame:
    """Ids with any component more than ``threshold`` population deviations off."""
    stats = rows.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns],
                              *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).alias("s")).scalar()
    out = F.lit(False)
    for c in columns:
        z = F.abs(F.col(c) - F.col("_s")[f"m_{c}"]) / F.when(F.col("_s")[f"s_{c}"] > 0, F.col("_s")[f"s_{c}"])
        out = out | F.coalesce(z > threshold, F.lit(False))
    return rows.withColumn("_s", stats).where(out).select("id")


def cluster_outliers(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("cluster") == -1).select("id")


def distance_outliers(vectors: DataFrame, threshold: float = 2.0) -> DataFrame:
    """(id, mean_dist) whose mean distance to all structures stands out."""
    means = cut_lineage(mean_distances(vectors))
    limit = means.agg((F.avg("mean_dist") + threshold * F.stddev_pop("mean_dist")).alias("t")).scalar()
    return means.where(F.col("mean_dist") > limit)


def outlier_table(structures: DataFrame, outliers: DataFrame) -> DataFrame:
    """Structure rows of the outliers; one row each however many rules matched."""
    return structures.join(outliers.select("id").distinct(), "id", "left_semi")


def outlier_atoms(atoms: DataFrame, outliers: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per-atom detail of the outlier structures."""
    return atoms.join(outliers.select(*key).distinct(), list(key), "left_semi")
