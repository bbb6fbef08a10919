"""Beads to training sets, and temperature labels."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.metadata import natural_key
from trajlake.operators import training as T
from trajlake.operators.thermo import constant_labels, in_unit
from trajlake.session import cut_lineage, tidy
from trajlake.sinks import training as sink
from trajlake.sources.lines import read_lines, with_line_no
from trajlake.sources.thermo import read_thermo, temperature_series

FRAME = ["file", "frame_idx"]
GROUP = ["sim_type", "temp", "n_beads"]


def training_rows(beads: DataFrame, boxes: DataFrame, num_sets: int = 1, use_type_column: bool = True) -> DataFrame:
    """Packed frames with box, set and frame number per (sim, temp, bead count).

    Frames of different bead counts form groups of their own, and frames are
    numbered by natural path order, then by their place in the file.
    """
    source = "type" if use_type_column else ("n_atoms" if "n_atoms" in beads.columns else None)
    labels = ["sim_type", "temp"]
    packed = cut_lineage(T.pack_typed_frames(beads, FRAME, source, labels))
    heads = T.frame_heads(packed, FRAME, labels).join(boxes.select(*FRAME, "cell"), FRAME)
    placed = T.split_sets(heads, GROUP, num_sets, [natural_key(F.col("file")), F.col("file"), F.col("frame_idx")])
    return T.coded(packed.drop(*labels).join(placed, FRAME))


def _of_frame(name: str) -> Column | None:
    """The values of a quantity that a frame has once, not for every bead."""
    return F.array("total_energy") if name == "energy" else F.col("cell") if name == "box" else None


def _in_chunk_order(name: str):
    parts = F.array_sort(F.collect_list(F.struct("chunk", name)))
    return F.flatten(F.transform(parts, lambda s: s[name])).alias(name)


def write_training_set(rows: DataFrame, path: str, raw: bool = True, npy: bool = True) -> None:
    """``.raw`` text folders and ``set.NNN/*.npy`` files per (sim, temp, bead count)."""
    with tidy(rows.sparkSession):
        rows = cut_lineage(rows)
        if raw:
            for name in sink.QUANTITIES:
                write_text(rows, path, name)
            write_type_lines(rows, path)
        if npy:
            write_sets(rows, path, sink.QUANTITIES)


def write_text(rows: DataFrame, path: str, name: str) -> None:
    """One quantity of stored training rows as ``<name>.raw`` text."""
    if (values := _of_frame(name)) is not None:
        rows = rows.where(F.col("chunk") == 0).select(*GROUP, "frame_no", values.alias(name))
    else:
        # a line holds a whole frame; chunks of giant frames are put back together here only
        cut = F.col("n") != F.col("n_beads")
        rows = rows.where(~cut).select(*GROUP, "frame_no", name).unionByName(
            rows.where(cut).groupBy(*GROUP, "frame_no").agg(_in_chunk_order(name)))
    sink.write_raw(rows, f"{path}/{name}.raw", GROUP, ["frame_no"], name)


def write_sets(rows: DataFrame, path: str, names: Sequence[str]) -> None:
    """Some quantities of stored training rows as ``set.NNN/<name>.npy``, all from one sort."""
    group = F.concat_ws("/", F.col("sim_type"), F.coalesce(F.col("temp").cast("string"), F.lit("ramp")),
                        F.format_string("n%d", "n_beads"))

    def values(name):
        own = _of_frame(name)
        return F.col(name) if own is None else F.when(F.col("chunk") == 0, own).otherwise(F.array().cast("array<double>"))

    sink.write_arrays(rows, path, F.concat_ws("/", group, F.format_string("set.%03d", "set_id")), ["frame_no", "chunk"],
                      {name: (values(name), name == "energy") for name in names}, ["frame_no"])


def write_type_lines(rows: DataFrame, path: str) -> None:
    """``type.raw`` and ``type_map.raw`` of stored training rows."""
    with tidy(rows.sparkSession):
        sink.write_types(T.type_map(rows, GROUP, ["frame_no"]), path, GROUP)


def measured_labels(spark: SparkSession, logs: str | Sequence[str], unit: str = "eV") -> DataFrame:
    """(file, block_id, first_line, fparam) in log order."""
    series = temperature_series(read_thermo(spark, logs))
    return series.withColumn("fparam", in_unit(F.col("temp"), unit)).drop("temp")


def write_labels(rows: DataFrame, path: str, by: Sequence[str], order: Sequence[str]) -> None:
    """``fparam.raw`` text per group, and the same values as ``set.000/fparam.npy``."""
    sink.write_labels(rows, f"{path}/fparam.raw", by, order)
    folder = F.concat_ws("/", *[F.col(c).cast("string") for c in by], F.lit("set.000"))
    sink.write_npy(rows.withColumn("_v", F.array("fparam")), path, "fparam", folder, order, "_v", order, True)


def labels_for_boxes(spark: SparkSession, box_files: str | Sequence[str], temp: float, unit: str = "eV") -> DataFrame:
    """(file, frame_no, fparam): a constant label for every non-blank box line."""
    lines = read_lines(spark, box_files).where(F.trim("value") != "")
    return constant_labels(with_line_no(lines, "frame_no").select("file", "frame_no"), F.lit(temp), unit)
