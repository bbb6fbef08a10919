"""Measured temperature and pressure for frames."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import kelvin_to_ev
from trajlake.operators.joins import join_keys


def block_means(thermo: DataFrame, source: Sequence[str]) -> DataFrame:
    """(source, block_id, mean_temp); a block without temperatures has none."""
    return thermo.groupBy(*source, "block_id").agg(F.avg("temp").alias("mean_temp"))


def join_thermo(frames: DataFrame, thermo: DataFrame, source: Sequence[str] = ("sim",),
                step: str = "step", nominal: str = "temp_nominal",
                max_gap: float | None = 50.0) -> DataFrame:
    """Add temp_measured and pressure of the frame's step to every frame.

    Of the blocks that hold the step, the one whose mean temperature is closest
    to the nominal one counts (the first on ties, and for frames without a
    nominal temperature); more than ``max_gap`` off means no match.
    ``thermo`` has each step once per block.
    """
    source = list(source)
    rows = thermo.join(block_means(thermo, source), [*source, "block_id"])
    # the best block of every distinct (source, step, nominal), so that the join below never multiplies frames
    asked = frames.select(*source, step, F.col(nominal).alias("_goal")).distinct()
    gap = F.when(F.col("_goal").isNull(), F.lit(0.0)).otherwise(
        F.abs(F.coalesce("mean_temp", F.lit(float("inf"))) - F.col("_goal")))
    options = rows.select(*source, F.col("step").alias(step), "block_id", "mean_temp", "temp", "press")
    best = asked.join(options, [*source, step]).groupBy(*source, step, "_goal").agg(
        F.min(F.struct(gap.alias("gap"), "block_id", "temp", "press")).alias("_best"))
    out = join_keys(frames.withColumn("_goal", F.col(nominal)), best, [*source, step, "_goal"], "left")
    near = F.lit(True) if max_gap is None else F.col("_best.gap") <= max_gap
    return out.withColumns({
        "temp_measured": F.when(near, F.col("_best.temp")),
        "pressure": F.when(near, F.col("_best.press"))}).drop("_best", "_goal")


def coverage(frames: DataFrame) -> DataFrame:
    """Ranges of measured temperature and pressure, and the matched share in percent."""
    matched = F.col("temp_measured").isNotNull() & F.col("pressure").isNotNull()

    def when(c: str) -> Column:
        return F.when(matched, F.col(c))

    return frames.agg(
        F.count(F.lit(1)).alias("n_frames"), F.count_if(matched).alias("n_matched"),
        (F.count_if(matched) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("matched_pct"),
        F.min(when("temp_measured")).alias("temp_min"), F.max(when("temp_measured")).alias("temp_max"),
        F.min(when("pressure")).alias("pressure_min"), F.max(when("pressure")).alias("pressure_max"))


def in_unit(kelvin: Column, unit: str) -> Column:
    """Temperature in K or eV."""
    return kelvin_to_ev(kelvin) if unit == "eV" else kelvin


def constant_labels(frames: DataFrame, temp: Column, unit: str = "eV") -> DataFrame:
    """One temperature label per frame row."""
    return frames.withColumn("fparam", in_unit(temp.cast("double"), unit))
