"""Text lines with a stable place inside their file.

A line is located by (file, start of its file split, running number inside the
split), so files are read in parallel splits and still have an order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str], line_sep: str | None = None,
               **options) -> DataFrame:
    """(file, split_start, seq, value)."""
    reader = spark.read.options(**options)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("seq"), "value")


def with_line_no(lines: DataFrame, out: str = "line_no") -> DataFrame:
    """Add the 0-based position of each row of ``lines``, filtered or not, in its file.

    The rows of a split follow each other in one task, so they are numbered
    where they are read and no text is shuffled; both readings of the files
    are planned alike.  One row per file split is broadcast.
    """
    rows = lines.withColumn("_at", F.monotonically_increasing_id())
    first = rows.groupBy("file", "split_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("file").orderBy("split_start").rowsBetween(W.unboundedPreceding, -1)
    shift = first.select("file", "split_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(F.broadcast(shift), ["file", "split_start"]).withColumn(
        out, (F.col("_at") + F.col("_shift")).cast("bigint")).drop("_at", "_shift")


def count_filled_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, n_lines): non-blank lines per text file."""
    return (spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
            .where(F.trim("value") != "").groupBy("file").agg(F.count(F.lit(1)).alias("n_lines")))


def numbers(text: Column) -> Column:
    """Whitespace-separated numbers of a text column as an array of doubles."""
    parts = F.filter(F.split(text, r"\s+"), lambda p: p != "")
    return F.transform(parts, lambda p: p.try_cast("double"))
