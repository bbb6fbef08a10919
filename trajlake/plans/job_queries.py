"""Registered queries that run whole jobs, most of them on files written from the tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import cell9, magnitude, round_to
from trajlake.operators import audit as A
from trajlake.operators.beads import BeadRules
from trajlake.plans import audit_queries as aq
from trajlake.plans import bindings as at
from trajlake.plans.analysis import select_structures
from trajlake.plans.bead_queries import CUTOFF, GREEDY_SQL, PATTERNS
from trajlake.plans.coarse_graining import coarse_grain_dumps, run_counters
from trajlake.plans.file_queries import _name
from trajlake.plans.structure_queries import DBSCAN_SQL, EPS, MIN_SAMPLES
from trajlake.plans.training_sets import training_rows
from trajlake.session import cut_lineage, shared_folder
from trajlake.sinks.dumps import bead_dump_lines, write_dump
from trajlake.sinks.tables import list_text, write_boxes, write_table
from trajlake.sources.tables import read_beads_csv, read_boxes_csv, read_projection_csv


def _dumps(spark, sf_dir) -> str:
    """Atoms as dumps below one folder per simulation."""
    rows = cut_lineage(at.atoms(spark, sf_dir, labels=True).withColumn("sim", F.substring("sim_type", 1, 1)))
    boxes = rows.select("sim", "frame", "lx", "ly", "lz").distinct().select(
        "sim", "frame", F.col("frame").alias("timestep"), cell9(F.col("lx"), F.col("ly"), F.col("lz")).alias("cell"))
    folder = shared_folder(rows)
    write_dump(bead_dump_lines(rows, boxes, ["sim", "frame"]), folder, "sim", ["frame"])
    return folder


def coarse_grain_job(spark, sf_dir) -> DataFrame:
    """Dumps to beads: beads, members and mean force of every simulation."""
    out = coarse_grain_dumps(spark, [f"{_dumps(spark, sf_dir)}/sim=*"], BeadRules(patterns=PATTERNS, r_cutoff=CUTOFF))
    rows = out.beads.groupBy(_name().alias("sim"), F.col("timestep").alias("frame")).agg(
        F.count(F.lit(1)).alias("n_beads"), F.sum("n_atoms").alias("n_atoms"),
        F.avg(magnitude(F.col("fx"), F.col("fy"), F.col("fz"))).alias("force_mean"))
    return rows.withColumn("force_mean", round_to("force_mean", 9))


# dumps hold six decimals
_DUMPED_SQL = at.ATOMS_SQL.replace("atoms AS (", "raw AS (", 1) + """, atoms AS (
  SELECT * REPLACE (round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(fx, 6) AS fx, round(fy, 6) AS fy, round(fz, 6) AS fz) FROM raw)"""
COARSE_GRAIN_JOB = f"""WITH RECURSIVE {_DUMPED_SQL}, {at.PAIRS_SQL}, {GREEDY_SQL}, {at.LABELS_SQL},
b AS (SELECT m.frame, center_row, count(*) AS n, sum(fx * w) / sum(w) AS fx, sum(fy * w) / sum(w) AS fy, sum(fz * w) / sum(w) AS fz
  FROM members m JOIN (SELECT *, CASE type WHEN 1 THEN 12 ELSE 1 END::DOUBLE AS w FROM atoms) a
    ON a.frame = m.frame AND a.row_idx = m.row_idx GROUP BY m.frame, center_row)
SELECT substr(sim_type, 1, 1) AS sim, frame, count(*) AS n_beads, sum(n)::BIGINT AS n_atoms, round(avg(sqrt(fx*fx + fy*fy + fz*fz)), 9) AS force_mean
FROM b JOIN labels_of USING (frame) GROUP BY ALL"""


def coarse_grain_counters(spark, sf_dir) -> DataFrame:
    """Frames and beads of a run, over the outcome rows of its files."""
    out = coarse_grain_dumps(spark, [f"{_dumps(spark, sf_dir)}/sim=*"], BeadRules(patterns=PATTERNS, r_cutoff=CUTOFF))
    total = run_counters(out.outcomes).agg(F.sum("total_frames").alias("n_frames"), F.sum("total_beads").alias("n_beads"),
                                           F.sum("failed").alias("n_failed"))
    left = out.warnings.agg(F.count(F.lit(1)).alias("n_left_out"))
    return total.crossJoin(left)  # one row each


COARSE_GRAIN_COUNTERS = f"""WITH RECURSIVE {_DUMPED_SQL}, {at.PAIRS_SQL}, {GREEDY_SQL}
SELECT (SELECT count(DISTINCT frame) FROM atoms) AS n_frames, (SELECT count(*) FROM members WHERE pos = 0) AS n_beads, 0::BIGINT AS n_failed,
  (SELECT count(*) FROM atoms WHERE type = 1) - (SELECT count(*) FROM members WHERE pos = 0) AS n_left_out"""


def bead_csv_layouts(spark, sf_dir) -> DataFrame:
    """Beads in CSV files of two layouts in one folder tree, read together."""
    rows = at.atoms(spark, sf_dir)
    rows = cut_lineage(rows.select(
        "id", "type", "x", "fx", F.col("frame").alias("timestep"), list_text(F.array("row_idx", F.col("row_idx") + 1)).alias("atom_indices"),
        F.when(F.col("row_idx") % 2 == 0, "True").otherwise("False").alias("manual_assignment")))
    folder = shared_folder(rows)
    write_table(rows.where("timestep % 2 = 0"), f"{folder}/layout=a", fmt="csv")
    write_table(rows.where("timestep % 2 = 1").select("atom_indices", "timestep", "type", "id", "x", F.lit("pattern").alias("match_status")),
                f"{folder}/layout=b", fmt="csv")
    back = read_beads_csv(spark, [f"{folder}/layout=a", f"{folder}/layout=b"])
    return back.select(F.col("timestep").alias("frame"), "id", F.col("type").cast("bigint").alias("type"), round_to("x", 9).alias("x"),
                       round_to("fx", 9).alias("fx"), F.array_join(F.transform("atom_indices", lambda v: v.cast("string")), ";").alias("members"),
                       F.col("manual_assignment").alias("manual"), "match_status")


BEAD_CSV_LAYOUTS = f"""WITH {at.ATOMS_SQL}
SELECT frame, id, type::BIGINT AS type, round(x, 9) AS x, CASE WHEN frame % 2 = 0 THEN round(fx, 9) END AS fx, row_idx || ';' || (row_idx + 1) AS members,
  CASE WHEN frame % 2 = 0 THEN row_idx % 2 = 0 ELSE false END AS manual, CASE WHEN frame % 2 = 1 THEN 'pattern' END AS match_status FROM atoms"""


def box_csv_scan(spark, sf_dir) -> DataFrame:
    """Boxes written as CSV and read back."""
    rows = at.frame_labels(spark, sf_dir).select(
        F.col("frame").alias("timestep"), cell9(F.col("temp") / 10, F.lit(12.5), F.col("frame") % 7 + 1.0).alias("cell"))
    folder = shared_folder(rows)
    write_boxes(rows, folder, fmt="csv")
    back = read_boxes_csv(spark, folder)
    return back.select(F.col("timestep").alias("frame"), *[round_to(F.col("cell")[i], 9).alias(n) for i, n in ((0, "lx"), (4, "ly"), (8, "lz"))],
                       F.size("cell").cast("bigint").alias("n"))


BOX_CSV_SCAN = f"""WITH {at.LABELS_SQL} SELECT frame, round(temp / 10, 9) AS lx, 12.5::DOUBLE AS ly, frame % 7 + 1.0::DOUBLE AS lz, 9::BIGINT AS n FROM labels_of"""


def projection_scan(spark, sf_dir) -> DataFrame:
    """A projection table written as CSV and read back."""
    rows = at.descriptors(spark, sf_dir, 3).select(
        F.concat(F.lit("s/"), F.col("label"), F.lit("@"), F.col("id")).alias("structure_id"), F.col("id").alias("timestep"),
        F.when(F.col("id") % 3 > 0, F.col("label") * 100).alias("temp"), *[F.col(f"f{i}").alias(f"PC{i}") for i in (1, 2, 3)])
    folder = shared_folder(rows)
    write_table(rows, folder, fmt="csv")
    back = read_projection_csv(spark, folder)
    return back.select("structure_id", "timestep", F.col("temp").cast("bigint").alias("temp"), *[round_to(f"PC{i}", 9).alias(f"PC{i}") for i in (1, 2, 3)])


PROJECTION_SCAN = f"""WITH {at.descriptors_sql(3)}
SELECT 's/' || label || '@' || id AS structure_id, id AS timestep, CASE WHEN id % 3 > 0 THEN label * 100 END AS temp,
  round(f1, 9) AS PC1, round(f2, 9) AS PC2, round(f3, 9) AS PC3 FROM vectors"""


def training_job(spark, sf_dir) -> DataFrame:
    """Frames of 50 files as training rows in three sets per (simulation, temperature, bead count)."""
    rows = at.atoms(spark, sf_dir, labels=True).withColumns({
        "file": F.concat(F.lit("dump."), F.col("frame") % 50), "frame_idx": F.col("frame")})
    boxes = rows.select("file", "frame_idx", "lx", "ly", "lz").distinct().select(
        "file", "frame_idx", cell9(F.col("lx"), F.col("ly"), F.col("lz")).alias("cell"))
    out = training_rows(rows, boxes, 3)
    return out.groupBy("sim_type", "temp", "n_beads", "set_id").agg(
        F.count_distinct("file", "frame_idx").alias("n_frames"), round_to(F.sum(F.when(F.col("chunk") == 0, F.col("total_energy"))), 6).alias("energy"),
        F.sum(F.size("coord")).alias("n_values"), F.sum(F.col("frame_no") * F.col("frame_idx")).alias("order_mark"))


TRAINING_JOB = f"""WITH {at.ATOMS_SQL}, {at.LABELS_SQL},
f AS (SELECT frame, count(*) AS n_beads, sum(c_pe) AS e FROM atoms GROUP BY frame),
s AS (SELECT f.*, sim_type, temp, row_number() OVER w - 1 AS frame_no, ntile(3) OVER w - 1 AS set_id FROM f JOIN labels_of USING (frame)
  WINDOW w AS (PARTITION BY sim_type, temp, n_beads ORDER BY frame % 50, frame))
SELECT sim_type, temp, n_beads, set_id, count(*) AS n_frames, round(sum(e), 6) AS energy, sum(3 * n_beads)::BIGINT AS n_values,
  sum(frame_no * frame)::BIGINT AS order_mark FROM s GROUP BY ALL"""


def selection_job(spark, sf_dir) -> DataFrame:
    """Diverse picks per density cluster: as many as asked, or the whole cluster."""
    rows = at.descriptors(spark, sf_dir, 3).withColumnsRenamed({f"f{i}": f"PC{i}" for i in (1, 2, 3)})
    picks = select_structures(rows.drop("label"), 3, "pca", "dbscan", eps=EPS, min_samples=MIN_SAMPLES, include_noise=True)
    return picks.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"),
                                        F.max("selection_rank").cast("bigint").alias("last_rank"))


SELECTION_JOB = f"""WITH RECURSIVE {DBSCAN_SQL}
SELECT cluster, least(count(*), 3) AS n, least(count(*), 3) AS n_ids, least(count(*), 3) - 1 AS last_rank FROM labels GROUP BY cluster"""


def audit_file_status(spark, sf_dir) -> DataFrame:
    """All checks rolled up to files of the audited frames; some files can't be checked."""
    atoms, beads = aq._tables(spark, sf_dir)
    frames = A.frame_rollup(beads, A.audit_issues(beads, atoms, at.FRAME, aq.RULES), at.FRAME).withColumn("file", F.col("frame") % 400)
    bad = frames.select("file").distinct().where("file % 37 = 5").withColumn("reason", F.lit("unreadable"))
    out = A.file_rollup(frames, ["file"], bad)
    return out.select("file", "n_frames", "n_beads", "n_fail", "n_warn", "status", "reason")


AUDIT_FILE_STATUS = f"""WITH c AS ({aq.AUDIT_CONSERVATION}), s AS ({aq.AUDIT_SPAN}), v AS ({aq.AUDIT_FRAME_COVERAGE}), r AS ({aq.AUDIT_RULES}), {aq.TABLES_SQL},
i AS (SELECT frame, 'FAIL' AS severity FROM c UNION ALL SELECT frame, severity FROM s UNION ALL SELECT frame, 'FAIL' FROM v
  UNION ALL SELECT frame, severity FROM r),
n AS (SELECT frame, count(*) FILTER (severity = 'FAIL') AS f, count(*) FILTER (severity = 'WARN') AS w FROM i GROUP BY frame),
b AS (SELECT frame, count(*) AS n_beads FROM beads GROUP BY frame)
SELECT frame % 400 AS file, count(*) AS n_frames, sum(n_beads)::BIGINT AS n_beads, coalesce(sum(f), 0)::BIGINT AS n_fail, coalesce(sum(w), 0)::BIGINT AS n_warn,
  CASE WHEN frame % 400 % 37 = 5 THEN 'BAD' WHEN coalesce(sum(f), 0) > 0 THEN 'FAIL' ELSE 'OK' END AS status,
  CASE WHEN frame % 400 % 37 = 5 THEN 'unreadable' END AS reason FROM b LEFT JOIN n USING (frame) GROUP BY frame % 400"""

QUERIES = {
    "coarse_grain_job": (coarse_grain_job, COARSE_GRAIN_JOB),
    "coarse_grain_counters": (coarse_grain_counters, COARSE_GRAIN_COUNTERS),
    "bead_csv_layouts": (bead_csv_layouts, BEAD_CSV_LAYOUTS),
    "box_csv_scan": (box_csv_scan, BOX_CSV_SCAN),
    "projection_scan": (projection_scan, PROJECTION_SCAN),
    "training_job": (training_job, TRAINING_JOB),
    "selection_job": (selection_job, SELECTION_JOB),
    "audit_file_status": (audit_file_status, AUDIT_FILE_STATUS),
}
