"""Dumps to beads: the coarse-graining job."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.geometry import cell9
from trajlake.functions.metadata import dump_labels
from trajlake.operators.beads import BeadRules, assign_members, build_beads
from trajlake.operators.neighbors import with_position
from trajlake.operators.unwrap import unwrap_chain
from trajlake.session import cut_lineage
from trajlake.sources.frame_index import frame_index, indexed_atoms, list_files

FRAME = ["file", "frame_idx"]


@dataclass
class CoarseGrained:
    beads: DataFrame      # numbered beads with file, frame_idx, timestep, sim_type, temp
    boxes: DataFrame      # (file, frame_idx, timestep, cell)
    outcomes: DataFrame   # one row per file: ok, msg, frames, beads
    warnings: DataFrame   # one row per center left out


def labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("_l", dump_labels(F.col("file"))).select("*", "_l.sim_type", "_l.temp").drop("_l")


def coarse_grain_dumps(spark: SparkSession, paths: str | Sequence[str], rules: BeadRules,
                       **options) -> CoarseGrained:
    """Assign and aggregate beads of all valid frames behind ``paths``.

    One scan makes the frame index, a second read of the atom lines the stored
    atom table; everything after reads those tables.
    """
    index = frame_index(list_files(spark, paths, **options))
    records = index.frames
    atoms = cut_lineage(indexed_atoms(index.parts).drop("natoms"))
    heads = cut_lineage(records.where("ok").select(*FRAME, "timestep", "natoms", cell9(
        *[F.col("box")[i]["hi"] - F.col("box")[i]["lo"] for i in range(3)]).alias("cell")))
    moved = unwrap_chain(atoms, FRAME) if rules.unwrap_pbc else atoms
    placed = with_position(moved, rules.unwrapped)
    if rules.unwrap_pbc:
        placed = cut_lineage(placed)
    members, warnings = assign_members(placed, FRAME, rules)
    beads = build_beads(members, placed, FRAME, rules).join(heads.select(*FRAME, "timestep"), FRAME)
    counts = beads.groupBy("file").agg(F.count(F.lit(1)).alias("n_beads"))
    outcomes = (records.groupBy("file").agg(F.count_if("ok").alias("n_frames"), F.count_if(~F.col("ok")).alias("n_bad_frames"))
                .join(counts, "file", "left").withColumns({
                    "n_beads": F.coalesce("n_beads", F.lit(0)), "ok": F.col("n_frames") > 0,
                    "msg": F.when(F.col("n_frames") == 0, "no valid frame").otherwise("")}))
    return CoarseGrained(labelled(beads), heads.drop("natoms"), labelled(outcomes), warnings)


def run_counters(outcomes: DataFrame) -> DataFrame:
    """Files, frames and beads per simulation."""
    return outcomes.groupBy("sim_type").agg(
        F.count(F.lit(1)).alias("total_files"), F.count_if("ok").alias("success"), F.count_if(~F.col("ok")).alias("failed"),
        F.sum("n_frames").alias("total_frames"), F.sum("n_beads").alias("total_beads"))


def warning_rollup(warnings: DataFrame) -> DataFrame:
    """(message, n, first_file): repeated messages once, in order of first appearance."""
    message = F.concat_ws(" ", F.when(F.col("stage") == 2, "id pattern:").otherwise("distance:"), F.lit("center"),
                          F.col("center_id").cast("string"), "reason", F.col("bad_id").cast("string"))
    at = F.struct("file", "frame_idx", "stage", "center_row")
    rows = warnings.withColumn("message", message).groupBy("message").agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("_first"))
    return rows.orderBy("_first").select("message", "n", F.col("_first.file").alias("first_file"))
