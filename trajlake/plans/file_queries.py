"""Registered queries that go through files: tables are written in the native
formats by the sinks and read back by the sources."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions import metadata as M
from trajlake.functions.geometry import cell9, centered, round_to
from trajlake.functions.text import first_number, int_list, safe_name
from trajlake.operators.neighbors import with_position
from trajlake.plans import bindings as at
from trajlake.session import cut_lineage, shared_folder
from trajlake.sinks.dumps import bead_dump_lines, write_dump
from trajlake.sinks.training import write_raw
from trajlake.sources.dump import atom_rows, read_frames, valid_frames
from trajlake.sources.lines import count_filled_lines
from trajlake.sources.matrix import read_raw
from trajlake.sources.thermo import read_thermo


def _name():
    """The output folder a file was written to."""
    return F.regexp_extract("file", r"sim=([^/]*)/", 1)


def dump_round_trip(spark, sf_dir) -> DataFrame:
    """Atoms written as dumps (one per simulation, one frame per order) and scanned."""
    rows = cut_lineage(at.atoms(spark, sf_dir, labels=True).withColumn("sim", F.substring("sim_type", 1, 1)))
    boxes = rows.select("sim", "frame", "lx", "ly", "lz").distinct().select(
        "sim", "frame", F.col("frame").alias("timestep"), cell9(F.col("lx"), F.col("ly"), F.col("lz")).alias("cell"))
    folder = shared_folder(rows)
    write_dump(bead_dump_lines(rows, boxes, ["sim", "frame"]), folder, "sim", ["frame"])
    back = atom_rows(valid_frames(read_frames(spark, f"{folder}/sim=*")))
    return back.select(
        _name().alias("sim"), F.col("timestep").alias("frame"), "natoms", "row_idx", "id", F.col("type").cast("bigint").alias("type"),
        *[round_to(F.col(c), 6).alias(c) for c in ("xu", "yu", "zu", "fx", "fy", "fz")], "lx")


DUMP_ROUND_TRIP = f"""WITH {at.ATOMS_SQL}, {at.LABELS_SQL}
SELECT substr(sim_type, 1, 1) AS sim, frame, count(*) OVER (PARTITION BY frame) AS natoms, row_idx, id, type::BIGINT AS type,
  round(x, 6) AS xu, round(y, 6) AS yu, round(z, 6) AS zu, round(fx, 6) AS fx, round(fy, 6) AS fy, round(fz, 6) AS fz, lx
FROM atoms JOIN labels_of USING (frame)"""


def write_logs(rows: DataFrame) -> str:
    """Thermo rows as one log per simulation; returns the pattern of the logs."""
    lines = rows.select("sim", "block_id", "line_no", F.concat_ws(" ", "step", "temp", "press").alias("value"))
    edges = rows.select("sim", "block_id").distinct().select("sim", "block_id", F.explode(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("line_no"), F.lit("Step Temp Press").alias("value")),
        F.struct(F.lit(1 << 62).alias("line_no"), F.lit("Loop time of 1 on 8 procs").alias("value")))).alias("e")).select(
        "sim", "block_id", "e.*")
    folder = shared_folder(rows)
    # a log is one file, written in order
    (lines.unionByName(edges).repartition("sim").sortWithinPartitions("sim", "block_id", "line_no")
     .select("sim", "value").write.partitionBy("sim").text(folder))
    return f"{folder}/sim=*"


def thermo_log_scan(spark, sf_dir) -> DataFrame:
    """Events written as thermo logs (one per simulation) and parsed."""
    back = read_thermo(spark, write_logs(at.thermo(spark, sf_dir)))
    return back.select(_name().alias("sim"), F.col("block_id").cast("bigint").alias("block_id"), "step",
                       round_to("temp", 9).alias("temp"), round_to("press", 9).alias("press"))


THERMO_LOG_SCAN = f"""WITH {at.THERMO_SQL}
SELECT sim, dense_rank() OVER (PARTITION BY sim ORDER BY block_id) - 1 AS block_id, step, round(arg_max(temp, line_no), 9) AS temp,
  round(arg_max(press, line_no), 9) AS press FROM thermo GROUP BY sim, thermo.block_id, step"""


def matrix_scan(spark, sf_dir) -> DataFrame:
    """Descriptor matrix written as raw text per label and read with line numbers."""
    rows = at.descriptors(spark, sf_dir)
    folder = shared_folder(rows)
    write_raw(rows.withColumnRenamed("label", "sim"), folder, ["sim"], ["id"], "features")
    files = [f"{folder}/sim=*"]
    back = read_raw(spark, files).groupBy(_name().cast("bigint").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("values")).cast("bigint").alias("width"),
        F.sum(F.aggregate("values", F.lit(0.0), lambda a, v: a + v)).alias("total"))
    lines = count_filled_lines(spark, files).groupBy(_name().cast("bigint").alias("label")).agg(F.sum("n_lines").alias("n_lines"))
    return back.join(lines, "label").withColumn("total", round_to("total", 4))


MATRIX_SCAN = """WITH u AS (SELECT label::BIGINT AS label, vec_id, round(unnest(embedding)::DOUBLE, 8) AS v FROM embeddings)
SELECT label, count(DISTINCT vec_id) AS n, 64::BIGINT AS width, round(sum(v), 4) AS total, count(DISTINCT vec_id) AS n_lines FROM u GROUP BY label"""


def path_labels(spark, sf_dir) -> DataFrame:
    """Labels, ids and numbers read from dump paths of four layouts."""
    orders = at.frame_labels(spark, sf_dir)
    name = F.concat(F.lit("NPT."), F.col("temp"), F.lit("."), F.col("frame"))
    sim = F.concat(F.lit("/data/"), F.col("sim_type"))
    path = (F.when(F.col("frame") % 4 == 0, F.concat(sim, F.lit("/traj/"), name))
            .when(F.col("frame") % 4 == 1, F.concat(sim, F.lit("/"), F.col("temp"), F.lit("/"), name))
            .when(F.col("frame") % 4 == 2, F.concat(sim, F.lit("/"), F.col("temp"), F.lit("/traj/x"), F.col("frame")))
            .otherwise(F.concat(sim, F.lit("/"), name)))
    rows = orders.select("frame", path.alias("path")).withColumn("l", M.dump_labels(F.col("path")))
    identity = M.structure_id(F.col("l.sim_type"), F.col("l.temp"), F.col("frame"))
    return rows.select(
        "path", F.col("l.sim_type").alias("sim_type"), F.col("l.temp").cast("bigint").alias("temp"), identity.alias("structure_id"),
        safe_name(identity).alias("file_name"), M.step_of_id(identity).alias("step"),
        first_number(F.col("path")).alias("first_no"), first_number(F.col("path"), "last").alias("last_no"))


PATH_LABELS = f"""WITH {at.LABELS_SQL}, p AS (
  SELECT *, CASE frame % 4 WHEN 0 THEN '/data/' || sim_type || '/traj/NPT.' || temp || '.' || frame
      WHEN 1 THEN '/data/' || sim_type || '/' || temp || '/NPT.' || temp || '.' || frame
      WHEN 2 THEN '/data/' || sim_type || '/' || temp || '/traj/x' || frame ELSE '/data/' || sim_type || '/NPT.' || temp || '.' || frame END AS path,
    CASE WHEN frame % 4 = 0 THEN NULL ELSE temp END AS t FROM labels_of),
i AS (SELECT *, sim_type || '/' || coalesce(t::VARCHAR, 'ramp') || '@' || frame AS structure_id FROM p)
SELECT path, sim_type, t AS temp, structure_id, regexp_replace(structure_id, '[^A-Za-z0-9._-]', '_', 'g') AS file_name, frame AS step,
  CASE WHEN frame % 4 = 2 THEN frame ELSE temp END AS first_no, frame AS last_no FROM i"""


def list_cells(spark, sf_dir) -> DataFrame:
    """List cells of a text table; every fifth one is damaged."""
    lines = at.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    cell = F.concat(F.lit("["), F.col("l_partkey"), F.lit(", "), F.col("l_suppkey"), F.when(F.col("l_suppkey") % 5 == 0, ", x]").otherwise("]"))
    parsed = lines.select("l_orderkey", int_list(cell).alias("v"))
    return parsed.groupBy(F.col("l_orderkey").alias("frame")).agg(
        F.sum(F.size("v")).alias("n"), F.sum(F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("total"))


LIST_CELLS = """SELECT l_orderkey AS frame, sum(CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE 2 END)::BIGINT AS n,
  sum(CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE l_partkey + l_suppkey END)::BIGINT AS total FROM lineitem GROUP BY l_orderkey"""


def centered_positions(spark, sf_dir) -> DataFrame:
    rows = centered(with_position(at.atoms(spark, sf_dir)), at.FRAME)
    return rows.select("frame", "row_idx", *[round_to(F.col(p), 6).alias(p) for p in ("px", "py", "pz")])


CENTERED_POSITIONS = f"""WITH {at.ATOMS_SQL}
SELECT frame, row_idx, round(x - avg(x) OVER w, 6) AS px, round(y - avg(y) OVER w, 6) AS py, round(z - avg(z) OVER w, 6) AS pz
FROM atoms WINDOW w AS (PARTITION BY frame)"""

QUERIES = {
    "dump_round_trip": (dump_round_trip, DUMP_ROUND_TRIP),
    "thermo_log_scan": (thermo_log_scan, THERMO_LOG_SCAN),
    "matrix_scan": (matrix_scan, MATRIX_SCAN),
    "path_labels": (path_labels, PATH_LABELS),
    "list_cells": (list_cells, LIST_CELLS),
    "centered_positions": (centered_positions, CENTERED_POSITIONS),
}
