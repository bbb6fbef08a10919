"""Thermodynamic logs as tables.

A log is a sequence of blocks: a header line starting with ``Step``, number
rows, and ``Loop time`` or a blank line.  The block of a line is a running
count of end lines (per file split, with carried offsets), and the columns of
a block come from a join with its header line, so no file is handled whole.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.sources.lines import read_lines

# fixed values: recognised column names of a thermo header, and table names
COLUMNS = {"Temp": "temp", "Press": "press", "E_pair": "e_pair", "Lx": "lx", "Ly": "ly", "Lz": "lz"}


def read_thermo(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """(file, block_id, line_no, first_line, step, temp, press, e_pair, lx, ly, lz).

    A step repeated inside a block keeps its first place (``first_line``) and
    its last values (``line_no``).  Unreadable cells are NULL.
    """
    lines = read_lines(spark, paths, **options).withColumn("value", F.trim(F.regexp_replace("value", r"\s+", " ")))
    words = F.split("value", " ")
    is_row = F.get(words, F.lit(0)).rlike(r"^-*\d+$")
    named = F.lit(False)
    for name in COLUMNS:
        named = named | F.contains("value", F.lit(name))
    lines = lines.withColumns({
        "_row": is_row,
        "_end": ~is_row & (F.startswith("value", F.lit("Loop time")) | (F.col("value") == "")),
        "_head": F.startswith("value", F.lit("Step")) & named & F.array_contains(words, "Step")})

    # running count of end lines and running line number, per split, plus what earlier splits hold
    split = W.partitionBy("file", "split_start").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    per_split = lines.groupBy("file", "split_start").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_end").alias("_e"))
    earlier = W.partitionBy("file").orderBy("split_start").rowsBetween(W.unboundedPreceding, -1)
    per_split = per_split.select(
        "file", "split_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_e").over(earlier), F.lit(0)).alias("_e0"))
    placed = (lines.withColumns({"_n": F.count(F.lit(1)).over(split), "_e": F.count_if("_end").over(split)})
              .where(F.col("_row") | F.col("_head"))
              .join(per_split, ["file", "split_start"])
              .select("file", (F.col("_n0") + F.col("_n") - 1).alias("line_no"),
                      (F.col("_e0") + F.col("_e")).alias("_run"), "_row", "value"))

    # the first header after the last end line rules the rows behind it
    heads = (placed.where(~F.col("_row")).groupBy("file", "_run")
             .agg(F.min(F.struct("line_no", "value")).alias("h"))
             .select("file", "_run", F.col("h.line_no").alias("_at"), F.split("h.value", " ").alias("_names")))
    rows = placed.where("_row").join(heads, ["file", "_run"]).where(F.col("line_no") > F.col("_at"))

    def cell(name: str, kind: str):
        place = F.array_position("_names", name)
        return F.when(place > 0, F.get(F.split("value", " "), (place - 1).cast("int")).try_cast(kind))

    rows = rows.select("file", "_run", "line_no", cell("Step", "bigint").alias("step"),
                       *[cell(n, "double").alias(c) for n, c in COLUMNS.items()])
    rows = last_per_step(rows.where(F.col("step").isNotNull()), ["file", "_run"],
                         list(COLUMNS.values()))
    # blocks without rows do not count
    runs = rows.select("file", "_run").distinct().withColumn(
        "block_id", F.row_number().over(W.partitionBy("file").orderBy("_run")) - 1)
    return rows.join(runs, ["file", "_run"]).select(
        "file", "block_id", "line_no", "first_line", "step", *COLUMNS.values())


def last_per_step(rows: DataFrame, block: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of a block with each step once: last values, first and last line."""
    out = rows.groupBy(*block, "step").agg(
        F.max("line_no").alias("line_no"), F.min("line_no").alias("first_line"),
        F.max_by(F.struct(*values), "line_no").alias("_v"))
    return out.select(*block, "line_no", "first_line", "step", *[f"_v.{c}" for c in values])


def temperature_series(thermo: DataFrame) -> DataFrame:
    """(file, block_id, first_line, temp): temperatures in file order, all blocks."""
    return thermo.where(F.col("temp").isNotNull()).select("file", "block_id", "first_line", "temp")
