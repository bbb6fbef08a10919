"""Dataset profile, structure analysis and diverse-frame selection."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.metadata import (bead_dump_labels, bead_table_labels, clustering_columns, dump_labels,
                                         feature_columns, fill_metadata, natural_key, projection_space, resolved_step)
from trajlake.functions.text import safe_name
from trajlake.operators import clustering as C
from trajlake.operators import descriptors as D
from trajlake.operators import profile as P
from trajlake.operators.ordinals import ranged_position
from trajlake.operators.pairwise import distance_percentile
from trajlake.operators.sampling import limit_frames, sample_rows
from trajlake.operators.selection import select_maximin
from trajlake.session import cut_lineage
from trajlake.sinks.dumps import indexed_dump_lines, write_dump
from trajlake.sources.dump import canonical_atoms
from trajlake.sources.frame_index import FrameIndex, frame_index, indexed_atoms, indexed_lines, list_files, stat_files

FRAME = ["file", "frame_idx"]


@dataclass
class Profile:
    files: DataFrame
    rollup: DataFrame
    by_temperature: DataFrame


def profile_dataset(beads: DataFrame, base_dir: str | None = None, sample: float | None = None) -> Profile:
    """Per-file statistics, roll-ups and box plots over a bead table with ``file``.

    ``base_dir`` derives simulation and temperature from bead CSV paths; without
    it the table brings sim_type and temp.
    """
    rows = sample_rows(beads, sample)
    if base_dir is not None:
        rows = rows.withColumn("_l", bead_table_labels(F.col("file"), base_dir)).select("*", "_l.sim_type", "_l.temp").drop("_l")
    files = cut_lineage(P.file_profile(rows, ["file", "sim_type", "temp"]))
    return Profile(files, P.profile_rollup(files),
                   P.box_plot(P.controlled_temperature_only(files), ["sim_type", "temp"], "force_mean"))


@dataclass
class Structures:
    table: DataFrame      # one row per structure: id, labels, energies, PC1.., cluster
    vectors: DataFrame    # scaled descriptors
    variance: list[float]


def load_structures(spark: SparkSession, paths, max_frames: int | None = None, max_per_file: int | None = None,
                    bead_dumps: bool = True, **options) -> tuple[DataFrame, DataFrame]:
    """(frames, atoms) of all frames, in natural path order; the limits are the caller's choice."""
    index = frame_index(list_files(spark, paths, **options))
    frames = index.frames.where("ok").drop("ok")
    labels = bead_dump_labels if bead_dumps else dump_labels
    frames = limit_frames(frames, max_per_file, max_frames, natural_key(F.col("file")))
    frames = cut_lineage(frames.withColumn("_l", labels(F.col("file"))).select("*", "_l.sim_type", "_l.temp").drop("_l"))
    return frames, canonical_atoms(indexed_atoms(index.of(frames)))


def analyse_structures(frames: DataFrame, atoms: DataFrame, descriptor: str = "pairs", components: int = 10,
                       method: str = "dbscan", n_clusters: int = 4, min_samples: int = 5, seed: int = 42,
                       energies: DataFrame | None = None, space: str = "pca",
                       projection: DataFrame | None = None) -> Structures:
    """Describe, scale, project and cluster structures.

    ``descriptor`` is 'pairs', 'density' or 'angular'.  ``energies`` (file, frame_idx,
    total_energy) supplies energies that the dump itself does not carry.
    ``projection`` (id, tSNE or UMAP columns) may bring another space to cluster
    in; a space that is absent falls back to the first three components.
    """
    atoms = cut_lineage(atoms)
    if descriptor == "density":
        found = D.density_vectors(D.density_descriptor(atoms, FRAME), FRAME)
        # a frame whose atoms reach nobody still has a (zero) vector
        vectors = frames.select(*FRAME).join(found, FRAME, "left").withColumn(
            "features", F.coalesce("features", F.array_repeat(F.lit(0.0), D.DENSITY_SLOTS)))
    elif descriptor == "angular":
        vectors = D.spectrum_vectors(frames.select(*FRAME), D.angular_spectrum(atoms, FRAME), FRAME)
    elif descriptor != "pairs":
        raise ValueError(f"unknown descriptor {descriptor!r}")
    else:
        vectors = D.histogram_vectors(frames.select(*FRAME), D.pair_histogram(atoms, FRAME), FRAME)
    facts = atoms.groupBy(*FRAME).agg(F.avg("c_pe").alias("mean_energy"), F.stddev_pop("c_pe").alias("std_energy"),
                                      F.sum("c_pe").alias("_sum"))
    table = frames.select(*FRAME, "timestep", "sim_type", "temp").join(facts, FRAME, "left")
    if energies is not None:
        table = table.join(energies.select(*FRAME, "total_energy"), FRAME, "left")
    else:
        table = table.withColumn("total_energy", F.lit(None).cast("double"))
    table = fill_metadata(table.withColumn("total_energy", F.coalesce("total_energy", "_sum", F.lit(0.0))).drop("_sum"))
    table = table.withColumnRenamed("file", "source_file")
    # the id orders structures like their files: path order, then frame
    keys = cut_lineage(_structure_ids(frames))
    table = table.join(keys.withColumnRenamed("file", "source_file"), ["source_file", "frame_idx"])
    vectors = cut_lineage(vectors.join(keys, FRAME).drop(*FRAME))
    scaled = cut_lineage(D.standardize(vectors).select("id", "features"))
    scores, variance = D.principal_components(scaled, components)
    scores = cut_lineage(scores)
    if projection is not None:
        scores = cut_lineage(scores.join(projection, "id", "left"))
    points = C.as_vectors(scores, clustering_columns(scores.columns, space))
    clustered = cluster(points, method, n_clusters, None, min_samples, seed)
    table = table.join(scores, "id").join(clustered.select("id", "cluster"), "id", "left")
    return Structures(table, scaled, variance)


def _structure_ids(frames: DataFrame) -> DataFrame:
    return ranged_position(frames.select(*FRAME), [], [natural_key(F.col("file")), F.col("file"), F.col("frame_idx")], "id")


def cluster(points: DataFrame, method: str, n_clusters: int, eps: float | None, min_samples: int, seed: int,
            restarts: int = 1, at_least_one: bool = False) -> DataFrame:
    """k-means, or density clustering with an automatic eps when none is given."""
    if method == "kmeans":
        return C.kmeans(points, n_clusters, seed, restarts, at_least_one)[0]
    if method != "dbscan":
        raise ValueError(f"unknown method {method!r}")
    return C.dbscan(points, distance_percentile(points) if eps is None else eps, min_samples)


def bead_energies(beads: DataFrame, whole_file: bool = False) -> DataFrame:
    """(file, frame_idx, total_energy) from the bead table, which dumps do not carry.

    ``whole_file`` gives every frame the energy of its whole file.
    """
    keys = ["file"] if whole_file else FRAME
    sums = beads.groupBy(*keys).agg(F.sum("c_pe").alias("total_energy"))
    return beads.select(*FRAME).distinct().join(sums, keys) if whole_file else sums


def mark_selected(table: DataFrame, picks: DataFrame) -> DataFrame:
    """Add ``selected``: is the structure among the picks (by structure id)?"""
    chosen = picks.select("structure_id").distinct().withColumn("_s", F.lit(True))
    return table.join(chosen, "structure_id", "left").withColumn("selected", F.coalesce("_s", F.lit(False))).drop("_s")


def select_structures(table: DataFrame, n: int, space: str | None = None, method: str = "kmeans", n_clusters: int = 8,
                      eps: float | None = None, min_samples: int = 5, seed: int = 42,
                      include_noise: bool = False) -> DataFrame:
    """Diverse rows of a projection table, with cluster and selection_rank.

    Rows without all features are left out; the space is found from the column
    names unless given.
    """
    columns = feature_columns(table.columns, space or projection_space(table.columns))
    if "id" not in table.columns:
        table = table.withColumn("id", F.monotonically_increasing_id())
    rows = cut_lineage(table.dropna(subset=columns))
    points = cluster(C.as_vectors(rows, columns), method, n_clusters, eps, min_samples, seed, 10, True)
    picks = select_maximin(points, n, include_noise)
    return rows.drop("cluster", "selection_rank").join(picks, "id")


def attach_frames(picks: DataFrame, index: FrameIndex | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifest rows, dump lines to write) for picks with source_file and timestep.

    Without an index one is made of the files of the picks that exist.  Only
    the bytes of the picked frames are read then; of frames sharing a step the
    last one counts.  ``status`` tells what could not be found.
    """
    rows = cut_lineage(picks.withColumn("timestep", resolved_step(
        F.col("timestep") if "timestep" in picks.columns else F.lit(None), F.col("structure_id"))))
    if index is None:
        index = frame_index(stat_files(rows.select(F.col("source_file").alias("file"))))
    frames = index.frames.withColumn("_path", _plain(F.col("file")))
    known = frames.select("_path").distinct().withColumn("_known", F.lit(True))
    last = (frames.where("ok").join(rows.select(_plain(F.col("source_file")).alias("_path"), "timestep").distinct(), ["_path", "timestep"], "left_semi")
            .groupBy("_path", "timestep").agg(F.max("offset").alias("offset")))
    name = F.concat(safe_name(F.coalesce("structure_id", F.concat(F.lit("frame_"), F.col("timestep").cast("string")))), F.lit(".lammpstrj"))
    manifest = cut_lineage(
        rows.withColumn("_path", _plain(F.col("source_file"))).join(last, ["_path", "timestep"], "left").join(known, "_path", "left")
        .withColumns({"status": F.when(F.col("offset").isNotNull(), "written").when(F.col("_known"), "no such frame").otherwise("source missing"),
                      "output_file": F.when(F.col("offset").isNotNull(), name).otherwise("")}))
    out = manifest.where("offset is not null").select("_path", "timestep", "offset", F.regexp_replace("output_file", r"\.lammpstrj$", "").alias("out_name"))
    wanted = cut_lineage(frames.join(out, ["_path", "timestep", "offset"]))
    return manifest.drop("_path", "_known", "offset"), indexed_dump_lines(wanted, indexed_lines(index.of(wanted)), ["out_name", "timestep"])


def write_picks(lines: DataFrame, path: str) -> None:
    write_dump(lines, path, "out_name", ["timestep"])


def _plain(path):
    return F.regexp_replace(path, "^file:/*", "/")
