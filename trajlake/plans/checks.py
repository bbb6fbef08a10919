"""P/T coverage, bead audit over files, prediction scoring."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.metadata import dump_labels, log_folder, natural_key, structure_id
from trajlake.operators import audit as A
from trajlake.operators import metrics as M
from trajlake.operators.beads import BeadRules
from trajlake.operators.neighbors import with_position
from trajlake.operators.sampling import even_downsample
from trajlake.operators.thermo import join_thermo
from trajlake.operators.unwrap import unwrap_chain
from trajlake.session import cut_lineage
from trajlake.sources.frame_index import frame_index, indexed_atoms, list_files
from trajlake.sources.matrix import read_matrix
from trajlake.sources.thermo import read_thermo


def keep_matching(rows: DataFrame, sims: Sequence[str] | None, temps: Sequence[int] | None,
                  keep_all_if_empty: bool = True) -> DataFrame:
    """Filter by simulation and temperature; a filter that matches nothing keeps all."""
    out = rows
    if sims:
        out = out.where(F.col("sim_type").isin(list(sims)))
    if temps:
        out = out.where(F.col("temp").isin(list(temps)))
    return rows if keep_all_if_empty and out is not rows and out.isEmpty() else out


def keep_temperatures(rows: DataFrame, temps: Sequence[int] | None) -> DataFrame:
    """Temperature filter that lets rows without a temperature (ramps) through."""
    return rows if not temps else rows.where(F.col("temp").isNull() | F.col("temp").isin(list(temps)))


def pressure_temperature(spark: SparkSession, dumps, logs, log_dir: str, sims: Sequence[str] | None = None,
                         temps: Sequence[int] | None = None, max_frames: int | None = None, **options) -> DataFrame:
    """First frame of every dump with the temperature and pressure its log measured.

    Logs are ``<folder>/log.lammps`` right under ``log_dir``.
    """
    frames = frame_index(list_files(spark, dumps, **options)).frames.where("frame_idx = 0").select("file", "timestep")
    frames = frames.withColumn("_l", dump_labels(F.col("file"))).select("file", "timestep", "_l.sim_type", "_l.temp")
    frames = keep_matching(frames, sims, temps)
    frames = frames.withColumn("sim", log_folder(F.col("file"), log_dir))
    thermo = read_thermo(spark, logs).withColumn(
        "sim", F.regexp_replace(F.regexp_replace("file", "^file:/*", "/"), "/[^/]*$", ""))
    rows = join_thermo(frames.withColumnsRenamed({"timestep": "step", "temp": "temp_nominal"}), thermo)
    rows = rows.select(
        structure_id(F.col("sim_type"), F.col("temp_nominal"), F.col("step")).alias("structure_id"), "sim_type",
        "temp_nominal", "temp_measured", "pressure", F.col("step").alias("timestep"), F.col("file").alias("source_file"))
    if max_frames is None:
        return rows
    return even_downsample(rows, max_frames, [natural_key(F.col("source_file")), F.col("source_file")])


@dataclass
class Audit:
    issues: DataFrame     # typed issues with file, sim, temp, timestep
    frames: DataFrame
    files: DataFrame      # OK / FAIL / BAD per file
    worst: DataFrame      # largest recompute errors per file


def audit_files(spark: SparkSession, beads: DataFrame, sources: DataFrame, dumps, rules: BeadRules,
                checks: Sequence[str] = ("pbc", "conservation", "coverage", "manual"), force_tol: float = 1e-4,
                pe_tol: float = 1e-6, span: float = 0.45, **options) -> Audit:
    """Audit bead rows (with ``file`` and ``timestep``) against their dumps.

    ``sources`` is (bead_file, source).  Of atom frames sharing a step the
    first one counts.
    """
    frame = ["file", "timestep"]
    index = frame_index(list_files(spark, dumps, **options))
    records = index.frames.where("ok").groupBy("file", "timestep").agg(F.min("frame_idx").alias("frame_idx")).withColumn("source", F.col("file"))
    plain = F.regexp_replace("file", "^file:/*", "/")
    link = sources.where(F.col("source").isNotNull()).select(
        F.col("bead_file"), F.regexp_replace("source", "^file:/*", "/").alias("_path"))
    records = records.withColumn("_path", plain).join(link, "_path").drop("_path", "file").withColumnRenamed("bead_file", "file")
    bad = A.bad_files(beads, records)
    unresolved = beads.select("file").distinct().join(
        sources.where(F.col("source").isNotNull()).select(F.col("bead_file").alias("file")), "file", "left_anti").select(
        "file", F.lit("atom source not found").alias("reason"))
    bad = cut_lineage(bad.unionByName(unresolved).groupBy("file").agg(F.min("reason").alias("reason")))
    good = cut_lineage(beads.join(bad, "file", "left_anti"))
    wanted = records.join(good.select(*frame).distinct(), frame, "left_semi").select("source", "frame_idx", "file")
    atoms = indexed_atoms(index.of(wanted.withColumnRenamed("file", "bead_file").withColumnRenamed("source", "file")))
    atoms = atoms.withColumnRenamed("file", "source").join(wanted, ["source", "frame_idx"]).drop("source", "frame_idx", "natoms")
    atoms = cut_lineage(with_position(unwrap_chain(atoms, frame) if rules.unwrap_pbc else atoms, rules.unwrapped))
    issues = cut_lineage(A.audit_issues(good, atoms, frame, rules, checks, force_tol, pe_tol, span))
    frames = cut_lineage(A.frame_rollup(good, issues, frame))
    labels = dump_labels(F.col("file"))
    issues = issues.withColumn("_l", labels).select(
        "*", F.col("_l.sim_type").alias("sim"), F.col("_l.temp").alias("temp")).drop("_l")
    return Audit(issues, frames, A.file_rollup(frames, ["file"], bad),
                 A.worst_errors(A.recompute(good, atoms, frame, rules), ["file"]))


def exit_code(files: DataFrame) -> int:
    """0 clean, 1 at least one failure, 2 files that could not be checked."""
    row = files.agg(F.count_if(F.col("status") == "FAIL").alias("f"), F.count_if(F.col("status") == "BAD").alias("b")).first()
    return 2 if row["b"] else (1 if row["f"] else 0)


def score_predictions(spark: SparkSession, pred_dir: str, ref_dir: str, max_frames: int | None = None,
                      quantities: Sequence[str] = ("force", "energy")) -> DataFrame:
    """(quantity, rmse, mae, r2, n_frames, n_unpaired) for the quantities both folders have.

    Forces are scored together and per component.  ``n_frames`` counts what was
    scored, ``n_unpaired`` what could not be (one side only, or unequal width).
    """
    out = None
    for name in quantities:
        try:
            pred, ref = read_matrix(spark, pred_dir, name), read_matrix(spark, ref_dir, name)
        except FileNotFoundError:
            continue
        if max_frames is not None:
            ref = ref.join(pred.select("frame_no"), "frame_no", "left_semi")
            ref = even_downsample(ref, max_frames, [F.col("frame_no")])
        # a limit leaves predictions without a reference on purpose
        shown = pred if max_frames is None else pred.join(ref.select("frame_no"), "frame_no", "left_semi")
        both = cut_lineage(M.matched_frames(shown, ref))  # the files are read and joined once
        values = M.frame_values(both)
        frames = M.equal_frames(both).where(F.size("p") > 0).agg(F.count_distinct("frame_no").alias("n")).scalar()
        unpaired = M.unequal_frames(both).agg(F.count(F.lit(1)).alias("n")).scalar()
        part = M.parity_metrics(values).select(F.lit(name).alias("quantity"), "rmse", "mae", "r2")
        if name == "force":
            axis = F.get(F.array(F.lit("x"), F.lit("y"), F.lit("z")), F.col("component").cast("int"))
            part = part.unionByName(M.parity_metrics(values, ["component"]).select(
                F.concat(F.lit("force_"), axis).alias("quantity"), "rmse", "mae", "r2"))
        part = part.withColumns({"n_frames": frames, "n_unpaired": unpaired})
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError("no quantity is present in both folders")
    return out
