"""Dump files, written line by line.

A frame is a run of lines kept together by range partitioning on (output,
frame) and ordered by a sort that can spill; no frame is built as one value.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.session import cut_lineage
from trajlake.sinks.training import number_text

HEAD = 9  # header lines of a frame


def _header(step: Column, count: Column, box: Sequence[Column], columns: Column) -> Column:
    lines = [F.lit("ITEM: TIMESTEP"), step.cast("string"), F.lit("ITEM: NUMBER OF ATOMS"), count.cast("string"),
             F.lit("ITEM: BOX BOUNDS pp pp pp"), *box, F.concat(F.lit("ITEM: ATOMS "), columns)]
    return F.array(*lines)


def bead_dump_lines(beads: DataFrame, boxes: DataFrame, frame: Sequence[str], unwrapped: bool = True,
                    keep_empty: bool = False) -> DataFrame:
    """(frame, line_no, value): beads by id, box from 0, six decimals.

    ``boxes`` has (frame, timestep, cell); frames without beads are left out, or heads of no atoms with ``keep_empty``.
    """
    frame = list(frame)
    names = "id type xu yu zu fx fy fz" if unwrapped else "id type x y z fx fy fz"
    sizes = beads.groupBy(*frame).agg(F.count(F.lit(1)).alias("_n"))
    axis = [F.format_string("%.6f %.6f 0.0", F.lit(0.0), F.col("cell")[i]) for i in (0, 4, 8)]
    heads = boxes.join(sizes, frame, "left" if keep_empty else "inner").select(*frame, F.posexplode(
        _header(F.col("timestep"), F.coalesce("_n", F.lit(0)), axis, F.lit(names))).alias("line_no", "value"))
    row = F.concat_ws(" ", F.col("id").cast("string"), F.col("type").cast("string"),
                      number_text(F.array("x", "y", "z", "fx", "fy", "fz"), "%.6f"))
    body = beads.select(*frame, (F.col("id") + (HEAD - 1)).alias("line_no"), row.alias("value"))
    return heads.withColumn("line_no", F.col("line_no").cast("bigint")).unionByName(body)


def plain_number(text: Column) -> Column:
    """A number as text: whole values without a fraction, others so that they
    read back to the same double; missing ones are 0."""
    value = text.try_cast("double")
    whole = (value == F.floor(value)) & (F.abs(value) < 9e15)
    return F.coalesce(F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string")), F.lit("0"))


def frame_dump_lines(frames: DataFrame, keep: Sequence[str], keep_tilt: bool = False) -> DataFrame:
    """(keep, line_no, value) of whole source frames, lossless.

    ``frames`` are records of the dump reader (timestep, natoms, box, columns, body).
    """
    heads = _frame_heads(frames, keep, keep_tilt)
    lines = F.filter(F.slice(F.split("body", "\n"), F.lit(1), F.greatest(F.col("natoms"), F.lit(0)).cast("int")),
                     lambda l: F.trim(l) != "")
    body = frames.select(*keep, F.size("columns").alias("_w"), F.posexplode(lines).alias("line_no", "_l"))
    return heads.unionByName(body.select(*keep, (F.col("line_no") + HEAD).alias("line_no"), _plain_cells("_l", "_w").alias("value")))


def indexed_dump_lines(frames: DataFrame, lines: DataFrame, keep: Sequence[str], keep_tilt: bool = False) -> DataFrame:
    """(keep, line_no, value) of indexed frames; ``lines`` are their atom lines (file, offset, line_no, value)."""
    body = lines.join(frames.select("file", "offset", *keep, F.size("columns").alias("_w")), ["file", "offset"])
    return _frame_heads(frames, keep, keep_tilt).withColumn("line_no", F.col("line_no").cast("bigint")).unionByName(
        body.select(*keep, (F.col("line_no") + HEAD).alias("line_no"), _plain_cells("value", "_w").alias("value")))


def _frame_heads(frames: DataFrame, keep: Sequence[str], keep_tilt: bool) -> DataFrame:
    def axis(i: int) -> Column:
        b = F.col("box")[i]
        tilt = F.coalesce(b["tilt"], F.lit(0.0)) if keep_tilt else F.lit(0.0)
        return F.concat_ws(" ", b["lo"].cast("string"), b["hi"].cast("string"), tilt.cast("string"))

    return frames.select(*keep, F.posexplode(_header(
        F.col("timestep"), F.col("natoms"), [axis(i) for i in range(3)], F.array_join("columns", " "))).alias("line_no", "value"))


def _plain_cells(line: str, width: str) -> Column:
    """The first ``width`` cells of a line as plain numbers."""
    words = F.filter(F.split(line, r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(F.sequence(F.lit(0), F.col(width) - 1), lambda i: plain_number(F.get(words, i))), " ")


def write_dump(lines: DataFrame, path: str, output: str, frame: Sequence[str]) -> None:
    """One folder ``<output>=<name>`` per output under ``path``; its part files in
    name order are the dump, and no frame is cut between two of them.

    The lines are stored first: finding the ranges would format all of them once more."""
    (cut_lineage(lines.select(output, *frame, "line_no", "value")).repartitionByRange(output, *frame).sortWithinPartitions(output, *frame, "line_no")
     .select(output, "value").write.mode("overwrite").partitionBy(output).text(path))
