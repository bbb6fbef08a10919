"""Exact interpolated quantiles per group."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.operators.joins import join_keys
from trajlake.operators.ordinals import ranged_position


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(keys, q): array of linearly interpolated quantiles of the non-null values.

    The values are range-sorted by (keys, value), so a group of any size is
    spread over partitions; only the rows at the wanted ranks are kept.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    placed = ranged_position(rows, keys, [F.col("_v")], "_at")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    hit = F.filter(F.transform(wanted, lambda p, i: F.struct(i.alias("i"), (p * (F.col("_n") - 1)).alias("place"))),
                   lambda w: (F.floor(w["place"]) == F.col("_at")) | (F.ceil(w["place"]) == F.col("_at")))
    found = (join_keys(placed, sizes, keys).withColumn("_w", F.explode(hit))
             .groupBy(*keys, "_w").agg(F.min("_v").alias("_a"), F.max("_v").alias("_b")))
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_w.place") - F.floor("_w.place"))
    return found.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("_w.i").alias("i"), value.alias("v")))), lambda s: s["v"]).alias("q"))
