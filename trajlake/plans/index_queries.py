"""Registered queries over the frame index of dump files written from the tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import cell9, round_to
from trajlake.plans import bindings as at
from trajlake.plans.analysis import attach_frames, write_picks
from trajlake.plans.file_queries import DUMP_ROUND_TRIP, _name
from trajlake.session import cut_lineage, shared_folder
from trajlake.sinks.dumps import bead_dump_lines, write_dump
from trajlake.sources.dump import canonical_atoms, frame_at, is_tilted
from trajlake.sources.frame_index import FrameIndex, frame_index, indexed_atoms, list_files, read_index_atoms

SPLIT = 1 << 16  # small ranges, so that files and frames are cut


def _index(spark, sf_dir, keep_empty: bool = False) -> FrameIndex:
    """Dumps of one folder per simulation, indexed; frames with a step divisible by 5 are tilted.

    An order without line items is a frame without atoms, written with ``keep_empty`` only.
    """
    rows = cut_lineage(at.atoms(spark, sf_dir, labels=True).withColumn("sim", F.substring("sim_type", 1, 1)))
    boxes = rows.select("sim", "frame", "lx", "ly", "lz").distinct().select(
        "sim", "frame", F.col("frame").alias("timestep"), cell9(F.col("lx"), F.col("ly"), F.col("lz")).alias("cell"))
    if keep_empty:
        boxes = at.frame_labels(spark, sf_dir).select(
            F.substring("sim_type", 1, 1).alias("sim"), "frame", F.col("frame").alias("timestep"), cell9(*[F.lit(v) for v in at.BOX]).alias("cell"))
    lines = bead_dump_lines(rows, boxes, ["sim", "frame"], keep_empty=keep_empty)
    tilted = F.when((F.col("line_no") == 5) & (F.col("frame") % 5 == 0), F.regexp_replace("value", r" 0\.0$", " 0.25")).otherwise(F.col("value"))
    folder = shared_folder(rows)
    write_dump(lines.withColumn("value", tilted), folder, "sim", ["frame"])
    return frame_index(list_files(spark, f"{folder}/sim=*"), SPLIT)


def indexed_frames(spark, sf_dir) -> DataFrame:
    """Headers of all frames from one scan: counts, box, tilt, and whether the atom lines lie where the index says."""
    index = _index(spark, sf_dir)
    parts = index.parts.groupBy("file", "frame_idx").agg(F.max("slot").alias("_slot"), F.sum(F.expr("stop - start")).alias("bytes"))
    rows = index.frames.where("ok").join(parts, ["file", "frame_idx"])
    return rows.select(_name().alias("sim"), F.col("timestep").alias("frame"), "natoms", (F.col("box")[0]["hi"] - F.col("box")[0]["lo"]).alias("lx"),
                       is_tilted(F.col("box")).alias("tilted"), F.array_join("columns", " ").alias("names"), (F.col("bytes") > 0).alias("found"))


INDEXED_FRAMES = f"""WITH {at.ATOMS_SQL}, {at.LABELS_SQL}
SELECT substr(any_value(sim_type), 1, 1) AS sim, frame, count(*) AS natoms, any_value(lx) AS lx, frame % 5 = 0 AS tilted,
  'id type xu yu zu fx fy fz' AS names, true AS found FROM atoms JOIN labels_of USING (frame) GROUP BY frame"""


def indexed_atom_scan(spark, sf_dir) -> DataFrame:
    """All atoms through the index."""
    back = canonical_atoms(indexed_atoms(_index(spark, sf_dir).parts))
    return back.select(
        _name().alias("sim"), F.col("timestep").alias("frame"), "natoms", "row_idx", "id", F.col("type").cast("bigint").alias("type"),
        *[round_to(F.col(c), 6).alias(n) for c, n in (("px", "xu"), ("py", "yu"), ("pz", "zu"), ("fx", "fx"), ("fy", "fy"), ("fz", "fz"))], "lx")


def indexed_step_range(spark, sf_dir) -> DataFrame:
    """Atoms of a range of steps through the data source; only bytes of those frames are read."""
    index = _index(spark, sf_dir)
    last = index.frames.agg((F.max("timestep") / 3).cast("bigint")).scalar()
    bounds = index.frames.sparkSession.range(1).select(last.alias("b")).first()["b"]
    atoms = read_index_atoms(index).where((F.col("timestep") >= bounds) & (F.col("timestep") < 2 * bounds))
    return atoms.groupBy(F.col("timestep").alias("frame")).agg(F.count(F.lit(1)).alias("n"), round_to(F.sum("xu"), 5).alias("xu"),
                                                                round_to(F.sum("fz"), 5).alias("fz"))


INDEXED_STEP_RANGE = f"""WITH {at.ATOMS_SQL}, b AS (SELECT max(frame) // 3 AS b FROM atoms)
SELECT frame, count(*) AS n, round(sum(round(x, 6)), 5) AS xu, round(sum(round(fz, 6)), 5) AS fz FROM atoms, b WHERE frame >= b AND frame < 2 * b
GROUP BY frame"""


def indexed_file_ends(spark, sf_dir) -> DataFrame:
    """First and last frame of each simulation's files, found by index from both ends."""
    frames = _index(spark, sf_dir, keep_empty=True).frames.where("ok")
    first, last = frame_at(frames, 0).groupBy(_name().alias("sim")).agg(F.min("timestep").alias("first")), frame_at(frames, -1).groupBy(
        _name().alias("sim")).agg(F.max("timestep").alias("last"))
    return first.join(last, "sim")


INDEXED_FILE_ENDS = f"""WITH {at.LABELS_SQL}
SELECT substr(sim_type, 1, 1) AS sim, min(frame) AS first, max(frame) AS last FROM labels_of GROUP BY 1"""


def picked_frames(spark, sf_dir) -> DataFrame:
    """Picks by step written as dumps of their own and read again; some steps and files don't exist."""
    index = _index(spark, sf_dir)
    every = index.frames.where("ok").select(F.col("file").alias("source_file"), F.col("timestep").alias("_step"))
    picks = every.where("_step % 97 = 0").select(
        F.concat(F.lit("p/1@"), "_step").alias("structure_id"),
        F.when(F.col("_step") % 5 == 2, F.concat("source_file", F.lit("-gone"))).otherwise(F.col("source_file")).alias("source_file"),
        F.when(F.col("_step") % 5 == 3, F.lit(-1)).otherwise(F.lit(None)).cast("bigint").alias("timestep"))
    manifest, lines = attach_frames(picks, index)
    folder = shared_folder(manifest)
    write_picks(lines, folder)
    back = indexed_atoms(frame_index(list_files(spark, f"{folder}/out_name=*")).parts)
    found = back.groupBy(F.regexp_extract("file", r"(\d+)/[^/]*$", 1).cast("bigint").alias("_step")).agg(F.count(F.lit(1)).alias("n_atoms"), round_to(
        F.sum("yu"), 5).alias("yu"))
    step = F.regexp_extract("structure_id", r"@(\d+)$", 1).cast("bigint").alias("frame")
    return manifest.select(step, "status").join(found, F.col("frame") == F.col("_step"), "left").drop("_step")


PICKED_FRAMES = f"""WITH {at.ATOMS_SQL}
SELECT frame, CASE frame % 5 WHEN 2 THEN 'source missing' WHEN 3 THEN 'no such frame' ELSE 'written' END AS status,
  CASE WHEN frame % 5 NOT IN (2, 3) THEN count(*) END AS n_atoms, CASE WHEN frame % 5 NOT IN (2, 3) THEN round(sum(round(y, 6)), 5) END AS yu
FROM atoms WHERE frame % 97 = 0 GROUP BY frame"""

QUERIES = {
    "indexed_frames": (indexed_frames, INDEXED_FRAMES),
    "indexed_atom_scan": (indexed_atom_scan, DUMP_ROUND_TRIP),
    "indexed_step_range": (indexed_step_range, INDEXED_STEP_RANGE),
    "indexed_file_ends": (indexed_file_ends, INDEXED_FILE_ENDS),
    "picked_frames": (picked_frames, PICKED_FRAMES),
}
