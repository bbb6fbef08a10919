"""Scoring predictions against references."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import is_finite


def finite_pairs(df: DataFrame, pred: str = "pred", ref: str = "ref") -> DataFrame:
    return df.where(is_finite(F.col(pred)) & is_finite(F.col(ref)))


def parity_metrics(df: DataFrame, keys: Sequence[str] = (), pred: str = "pred",
                   ref: str = "ref") -> DataFrame:
    """(keys, n, rmse, mae, r2); R2 is NULL when the reference does not vary.

    One pass of mergeable aggregates; the total sum of squares comes from the
    population variance.
    """
    d = F.col(pred) - F.col(ref)
    total = F.count(F.lit(1)) * F.var_pop(ref)
    return finite_pairs(df, pred, ref).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"),
        F.when(total > 1e-15, 1 - F.sum(d * d) / total).alias("r2"))


def error_summary(df: DataFrame, keys: Sequence[str] = (), pred: str = "pred",
                  ref: str = "ref") -> DataFrame:
    """Mean and population deviation of the errors."""
    d = F.col(pred) - F.col(ref)
    return df.where(is_finite(d)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(d).alias("mean"), F.stddev_pop(d).alias("std"))


def matched_frames(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(frame_no, p, r): the rows of both matrices side by side; a side without the frame is NULL."""
    return pred.select("frame_no", F.col("values").alias("p")).join(ref.select("frame_no", F.col("values").alias("r")), "frame_no", "full")


def equal_frames(matched: DataFrame) -> DataFrame:
    """The frames that can be scored: both sides have them with the same width."""
    return matched.where(F.col("p").isNotNull() & F.col("r").isNotNull() & (F.size("p") == F.size("r")))


def frame_values(matched: DataFrame) -> DataFrame:
    """(frame_no, pos, component, pred, ref) of frames that can be scored; ``component`` counts 0,1,2 along a row."""
    return equal_frames(matched).select("frame_no", F.posexplode(F.arrays_zip("p", "r")).alias("pos", "v")).select(
        "frame_no", "pos", (F.col("pos") % 3).alias("component"),
        F.col("v.p").alias("pred"), F.col("v.r").alias("ref"))


def paired_values(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(frame_no, pos, component, pred, ref) of the frames both matrices hold with the same width.

    Matrices are (frame_no, values); ``component`` counts 0,1,2 along a row.
    What is left out is listed by ``unpaired_frames``.
    """
    return frame_values(matched_frames(pred, ref))


def unpaired_frames(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(frame_no, pred_width, ref_width) of frames that can't be scored: only on one side, or of unequal width."""
    return unequal_frames(matched_frames(pred, ref))


def unequal_frames(matched: DataFrame) -> DataFrame:
    both = matched.select("frame_no", F.size("p").alias("pred_width"), F.size("r").alias("ref_width"))
    return both.where(~F.col("pred_width").eqNullSafe(F.col("ref_width")))
