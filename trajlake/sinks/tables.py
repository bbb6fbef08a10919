"""Table sinks: Parquet by simulation and temperature, CSV for exchange."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.audit import REPORT_COLUMNS
from trajlake.sources.tables import BOX_NAMES

BEAD_ORDER = ("id", "type", "x", "y", "z", "fx", "fy", "fz", "c_pe", "n_atoms", "atom_indices", "manual_assignment",
              "assigned_atom_ids", "match_status", "pattern", "id_pattern", "timestep")


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def list_text(values: Column) -> Column:
    """``[0, 1, 2]``."""
    return F.when(values.isNotNull(), F.concat(
        F.lit("["), F.array_join(F.transform(values, lambda v: v.cast("string")), ", "), F.lit("]")))


def beads_for_csv(beads: DataFrame) -> DataFrame:
    """Bead columns in their fixed order, lists as text."""
    out = beads.withColumns({c: list_text(F.col(c)) for c in ("atom_indices", "assigned_atom_ids", "pattern")})
    out = out.withColumns({"id_pattern": F.to_json("id_pattern"),
                           "manual_assignment": F.when(F.col("manual_assignment"), "True").otherwise("False")})
    extra = [c for c in out.columns if c not in BEAD_ORDER]
    return out.select(*BEAD_ORDER, *extra)


def write_beads(beads: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    write_table(beads_for_csv(beads) if fmt == "csv" else beads, path, by, fmt)


def boxes_for_csv(boxes: DataFrame) -> DataFrame:
    """Nine cell values under their customary names, the step last."""
    rest = [c for c in boxes.columns if c not in ("cell", "timestep")]
    return boxes.select(*rest, *[F.col("cell")[i].alias(n) for i, n in enumerate(BOX_NAMES)], "timestep")


def write_boxes(boxes: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    write_table(boxes_for_csv(boxes) if fmt == "csv" else boxes, path, by, fmt)


def audit_report(issues: DataFrame, failures_only: bool = False) -> DataFrame:
    """The sixteen report columns; missing ones are NULL."""
    rows = issues.where(F.col("severity") == "FAIL") if failures_only else issues
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in REPORT_COLUMNS])


def write_audit_report(issues: DataFrame, path: str, failures_only: bool = False) -> bool:
    """Write the report unless there is nothing to report."""
    report = audit_report(issues, failures_only)
    if report.isEmpty():
        return False
    write_table(report, path, fmt="csv")
    return True


def selection_manifest(picks: DataFrame, features: Sequence[str]) -> DataFrame:
    wanted = ["structure_id", "cluster", "selection_rank", "source_file", "timestep", "temp", *features, "output_file"]
    return picks.select(*[c for c in wanted if c in picks.columns])


def with_trace(scores: DataFrame, structures: DataFrame, key: str = "id") -> DataFrame:
    """Projection rows with the columns that lead back to their structure."""
    trace = ["timestep", "sim_type", "mean_energy", "structure_id", "source_file", "temp", "cluster"]
    have = [c for c in trace if c in structures.columns and c not in scores.columns]
    return scores.join(structures.select(key, *have), key)
