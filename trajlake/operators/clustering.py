"""Clustering of structures: k-means, density clustering, cluster summaries.

Density clustering works on grid cells with a diagonal of eps: all points of a
cell are neighbours of each other, so a cell with enough points is core as a
whole, and clusters are components of a graph over cells.  Points of crowded
cells are never paired with each other.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.components import connected_components
from trajlake.operators.ordinals import ranged_position
from trajlake.session import cut_lineage

SLACK = 1e-9
PAIR_BUDGET = 1_000_000


def as_vectors(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """Rows with all feature columns present, as ``features`` arrays."""
    return df.dropna(subset=list(columns)).select(
        *keep, F.array(*[F.col(c).cast("double") for c in columns]).alias("features"))


def kmeans(vectors: DataFrame, k: int, seed: int = 42, restarts: int = 1,
           at_least_one: bool = False) -> tuple[DataFrame, float]:
    """Add ``cluster``; the best of ``restarts`` seeded runs counts.

    ``k`` is limited to half the number of structures.
    """
    n = vectors.count()
    k = min(k, n // 2)
    if at_least_one:
        k = max(1, k)
    rows = vectors.withColumn("_v", array_to_vector("features"))
    if k <= 1:
        one = vectors.withColumn("cluster", F.lit(0))
        return one, float("nan")
    best = None
    for run in range(restarts):
        model = KMeans(k=k, seed=seed + run, featuresCol="_v", predictionCol="cluster").fit(rows)
        cost = model.summary.trainingCost
        if best is None or cost < best[1]:
            best = (model, cost)
    return best[0].transform(rows).drop("_v"), best[1]


def _box(dims: int, prefix: str = "") -> list[Column]:
    return ([F.min(F.col("features")[i]).alias(f"{prefix}lo{i}") for i in range(dims)]
            + [F.max(F.col("features")[i]).alias(f"{prefix}hi{i}") for i in range(dims)])


def _gap2(dims: int, a: str, b: str) -> Column:
    """Smallest squared distance of two boxes."""
    total = F.lit(0.0)
    for i in range(dims):
        g = F.greatest(F.lit(0.0), F.col(f"{b}lo{i}") - F.col(f"{a}hi{i}"), F.col(f"{a}lo{i}") - F.col(f"{b}hi{i}"))
        total = total + g * g
    return total


def _reach2(dims: int, a: str, b: str) -> Column:
    """Largest squared distance of two boxes."""
    total = F.lit(0.0)
    for i in range(dims):
        g = F.greatest(F.col(f"{b}hi{i}") - F.col(f"{a}lo{i}"), F.col(f"{a}hi{i}") - F.col(f"{b}lo{i}"))
        total = total + g * g
    return total


def _dist(dims: int, a: str, b: str) -> Column:
    total = None
    for i in range(dims):
        d = F.col(a)[i] - F.col(b)[i]
        total = d * d if total is None else total + d * d
    return F.sqrt(total)


def _prefixed(df: DataFrame, prefix: str, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(n).alias(prefix + n) for n in names])


def _near_cells(cells: DataFrame, dims: int, side: float, eps: float) -> DataFrame:
    """(a_cell, b_cell) both ways for occupied cells whose boxes come within eps.

    Cells meet through a coarse grid over the leading dimensions; the boxes
    then decide with all dimensions.
    """
    lead = min(dims, 3)
    coarse = side + eps * (1 + SLACK)
    names = ["cell", *[f"lo{i}" for i in range(dims)], *[f"hi{i}" for i in range(dims)]]
    at = [F.floor(F.col("cell")[i] * F.lit(side) / F.lit(coarse)) for i in range(lead)]
    home = cells.withColumns({f"g{i}": c for i, c in enumerate(at)})
    probe = home
    for i in range(lead):
        probe = probe.withColumn(f"g{i}", F.explode(F.array(*[F.col(f"g{i}") + o for o in (-1, 0, 1)])))
    grid = [f"g{i}" for i in range(lead)]
    a = probe.select(*grid, *[F.col(n).alias("a_" + n) for n in names])
    b = home.select(*grid, *[F.col(n).alias("b_" + n) for n in names])
    close = F.lit((eps * (1 + SLACK)) ** 2)
    return a.join(b, grid).where((F.col("a_cell") != F.col("b_cell")) & (_gap2(dims, "a_", "b_") <= close)).select(
        "a_cell", "b_cell")


def _links(core: DataFrame, near: DataFrame, dims: int, side: float, eps: float) -> DataFrame:
    """(a_cell, b_cell), a < b: cells with a pair of core points within eps.

    Decided on bounding boxes of ever finer sub-cells; points are compared only
    for sub-cell pairs that stay undecided and are small.
    """
    inner = F.lit((eps * (1 - SLACK)) ** 2)
    outer = F.lit((eps * (1 + SLACK)) ** 2)
    with_core = core.select("cell").distinct()
    open_pairs = (near.where(F.col("a_cell") < F.col("b_cell"))
                  .join(with_core.withColumnRenamed("cell", "a_cell"), "a_cell", "left_semi")
                  .join(with_core.withColumnRenamed("cell", "b_cell"), "b_cell", "left_semi"))
    size, found = side, None
    while True:
        sub = F.transform("features", lambda x: F.floor(x / F.lit(size)))
        subs = core.withColumn("sub", sub).groupBy("cell", "sub").agg(F.count(F.lit(1)).alias("n"), *_box(dims))
        names = ["cell", "sub", "n", *[f"lo{i}" for i in range(dims)], *[f"hi{i}" for i in range(dims)]]
        pairs = (open_pairs.join(_prefixed(subs, "a_", names), "a_cell").join(_prefixed(subs, "b_", names), "b_cell")
                 .where(_gap2(dims, "a_", "b_") <= outer)
                 .select("a_cell", "b_cell", "a_sub", "b_sub", (F.col("a_n") * F.col("b_n")).alias("work"),
                         (_reach2(dims, "a_", "b_") <= inner).alias("sure")))
        pairs = cut_lineage(pairs)
        sure = pairs.where("sure").select("a_cell", "b_cell").distinct()
        found = sure if found is None else found.union(sure)
        undecided = pairs.join(sure, ["a_cell", "b_cell"], "left_anti")
        heavy = undecided.where(F.col("work") > PAIR_BUDGET).select("a_cell", "b_cell").distinct()
        points = core.withColumn("sub", sub).select("cell", "sub", "features")
        light = undecided.join(heavy, ["a_cell", "b_cell"], "left_anti")
        hits = (light.join(_prefixed(points, "a_", ["cell", "sub", "features"]), ["a_cell", "a_sub"])
                .join(_prefixed(points, "b_", ["cell", "sub", "features"]), ["b_cell", "b_sub"])
                .where(_dist(dims, "a_features", "b_features") <= eps).select("a_cell", "b_cell").distinct())
        found = found.union(hits)
        if heavy.isEmpty():
            return found.distinct()
        open_pairs, size = cut_lineage(heavy), size / 4


def dbscan(vectors: DataFrame, eps: float, min_samples: int = 5) -> DataFrame:
    """Add ``cluster``: 0, 1, ... by lowest core id, -1 for noise.

    Neighbours are within ``eps`` inclusive and a point counts as its own
    neighbour.  A border point takes the lowest adjacent cluster.
    """
    dims = int(vectors.agg(F.max(F.size("features"))).first()[0] or 0)
    if dims == 0:
        return vectors.withColumn("cluster", F.lit(None).cast("bigint"))
    side = eps / math.sqrt(dims) * (1 - SLACK)
    # everything below depends on the place only, so copies are merged first
    places = vectors.groupBy("features").agg(F.min("id").alias("pid"), F.count(F.lit(1)).alias("w"))
    places = cut_lineage(places.withColumn("cell", F.transform("features", lambda x: F.floor(x / F.lit(side)))))
    cells = cut_lineage(places.groupBy("cell").agg(F.sum("w").alias("cw"), *_box(dims)))
    near = cut_lineage(_near_cells(cells, dims, side, eps))

    crowded = cells.where(F.col("cw") >= min_samples).select("cell")
    sparse = cut_lineage(places.join(crowded, "cell", "left_anti"))
    # neighbours of points in sparse cells: own cell whole, near cells whole if
    # their box is inside eps, else point by point
    boxes = _prefixed(cells, "b_", ["cell", "cw", *[f"lo{i}" for i in range(dims)], *[f"hi{i}" for i in range(dims)]])
    probe = (sparse.select("pid", "features", "cell").withColumnsRenamed({"cell": "a_cell", "features": "a_features"})
             .withColumns({f"a_{e}{i}": F.col("a_features")[i] for e in ("lo", "hi") for i in range(dims)})
             .join(near, "a_cell").join(boxes, "b_cell")
             .where(_gap2(dims, "a_", "b_") <= F.lit((eps * (1 + SLACK)) ** 2)))
    whole = _reach2(dims, "a_", "b_") <= F.lit((eps * (1 - SLACK)) ** 2)
    probe = cut_lineage(probe.select("pid", "a_features", "b_cell", "b_cw", whole.alias("whole")))
    inside = probe.where("whole").select("pid", F.col("b_cw").alias("c"))
    point = (probe.where(~F.col("whole"))
             .join(_prefixed(places, "b_", ["cell", "features", "w"]), "b_cell")
             .where(_dist(dims, "a_features", "b_features") <= eps).select("pid", F.col("b_w").alias("c")))
    own = sparse.join(cells.select("cell", "cw"), "cell").select("pid", F.col("cw").alias("c"))
    counts = own.union(inside).union(point).groupBy("pid").agg(F.sum("c").alias("c"))
    core_ids = counts.where(F.col("c") >= min_samples).select("pid")
    core = cut_lineage(places.join(crowded, "cell", "left_semi").select("pid", "features", "cell").unionByName(
        sparse.join(core_ids, "pid", "left_semi").select("pid", "features", "cell")))

    nodes = cut_lineage(core.groupBy("cell").agg(F.min("pid").alias("node")))
    links = _links(core, near, dims, side, eps)
    edges = (links.join(_prefixed(nodes, "a_", ["cell", "node"]), "a_cell")
             .join(_prefixed(nodes, "b_", ["cell", "node"]), "b_cell")
             .select(F.col("a_node").alias("u"), F.col("b_node").alias("v")))
    parts = connected_components(edges)
    labelled = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = ranged_position(labelled.select("component").distinct(), [], [F.col("component")], "cluster")
    cell_cluster = cut_lineage(labelled.join(names, "component").select("cell", "cluster"))

    core_labels = core.join(cell_cluster, "cell").select("pid", "cluster")
    fringe = sparse.select("pid", "cell", "features").join(core.select("pid"), "pid", "left_anti")
    same_cell = fringe.join(cell_cluster, "cell").select("pid", "cluster")
    beside = (probe.join(fringe.select("pid"), "pid", "left_semi")
              .join(_prefixed(core, "b_", ["cell", "features"]), "b_cell")
              .where(F.col("whole") | (_dist(dims, "a_features", "b_features") <= eps))
              .select("pid", "b_cell").distinct()
              .join(cell_cluster.withColumnRenamed("cell", "b_cell"), "b_cell").select("pid", "cluster"))
    border = same_cell.union(beside).groupBy("pid").agg(F.min("cluster").alias("cluster"))
    labels = places.select("pid", "features").join(core_labels.union(border), "pid", "left").select(
        "features", F.coalesce("cluster", F.lit(-1).cast("bigint")).alias("cluster"))
    return vectors.join(labels, "features").select(*vectors.columns, "cluster")


def cluster_summary(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(cluster, n, centroid columns), noise as cluster -1."""
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in columns])


def cluster_counts(rows: DataFrame) -> DataFrame:
    """Number of clusters, and of noise structures."""
    return rows.agg(F.countDistinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
                    F.count_if(F.col("cluster") == -1).alias("n_noise"))
