"""Even picks, per-file limits and seeded samples."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.functions.text import first_number
from trajlake.operators.ordinals import even_picks_rounding, even_picks_truncating, ranged_position


def even_downsample(df: DataFrame, picks: int | None, order: Sequence[Column]) -> DataFrame:
    """At most ``picks`` rows, evenly spread over the whole order (truncating rule)."""
    if picks is None:
        return df
    placed = ranged_position(df, [], order, "_at")
    n = placed.agg(F.count(F.lit(1)).alias("n")).scalar()
    return placed.withColumn("_n", n).where(
        even_picks_truncating(F.col("_at"), F.col("_n"), picks)).drop("_at", "_n")


def pick_files(files: DataFrame, limits: DataFrame | None, default: int | None,
               which: str = "first") -> DataFrame:
    """Evenly spread files per (sim, temp) by the number in their name (rounding rule).

    ``limits`` has (sim, temp, max_files); temp NULL is the limit of the
    simulation.  The most specific limit wins, then ``default``; no limit or a
    limit <= 0 keeps every file.
    """
    # a NULL temperature (ramps) is a group of its own
    rows = files.withColumns({"_t": F.coalesce(first_number(F.col("file"), which), F.lit(0)),
                              "_k": F.coalesce("temp", F.lit(-1))})
    want = F.lit(default).cast("int")
    if limits is not None:
        exact = limits.where(F.col("temp").isNotNull()).select("sim", F.col("temp").alias("_k"), F.col("max_files").alias("_exact"))
        sim = limits.where(F.col("temp").isNull()).select("sim", F.col("max_files").alias("_sim"))
        rows = rows.join(exact, ["sim", "_k"], "left").join(sim, "sim", "left")
        want = F.coalesce("_exact", "_sim", want)
    rows = rows.withColumn("_want", want)
    sizes = rows.groupBy("sim", "_k").agg(F.count(F.lit(1)).alias("_n"))
    placed = ranged_position(rows, ["sim", "_k"], [F.col("_t"), F.col("file")], "_at").join(sizes, ["sim", "_k"])
    keep = F.col("_want").isNull() | (F.col("_want") <= 0) | even_picks_rounding(F.col("_at"), F.col("_n"), F.col("_want"))
    return placed.where(keep).select(*files.columns)


def first_files(files: DataFrame, max_files: int | None, key: Column | None = None) -> DataFrame:
    """The first files by path (or natural path key)."""
    return files if not max_files else files.orderBy(key if key is not None else F.col("file")).limit(max_files)


def limit_frames(frames: DataFrame, max_per_file: int | None, max_frames: int | None,
                 order: Column) -> DataFrame:
    """First frames of each file, then a global cap in file order.

    Only file counts are windowed: a running sum tells how many frames each
    file may still give.
    """
    rows = frames if max_per_file is None else frames.where(F.col("frame_idx") < max_per_file)
    if max_frames is None:
        return rows
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_o", "file").rowsBetween(W.unboundedPreceding, -1)
    # at most max_frames files can still contribute
    files = files.withColumn("_o", order).orderBy("_o", "file").limit(max_frames).withColumn(
        "_left", F.lit(max_frames) - F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return rows.join(files.select("file", "_left"), "file").where(
        F.col("frame_idx") < F.col("_left")).drop("_left")


def _draw(df: DataFrame, keys: Sequence[str] | None, seed: int) -> Column:
    """A number in [0, 1) that depends on the row's keys only (default: all columns)."""
    return F.pmod(F.xxhash64(*(keys or df.columns), F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)


def sample_rows(df: DataFrame, fraction: float | None, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """Sample by a hash of the row, whatever the partitioning; None or >= 1 keeps everything."""
    return df if fraction is None or fraction >= 1 else df.where(_draw(df, keys, seed) < fraction)


def random_points(df: DataFrame, n: int, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """At most ``n`` rows by the order of a hash of the row, e.g. the points of a scatter."""
    return df.orderBy(_draw(df, keys, seed), *(keys or df.columns)).limit(n)
