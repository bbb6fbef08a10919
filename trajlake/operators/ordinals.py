"""Dense positions and even picks without one-task windows.

``row_number() over (partition by frame ...)`` puts a whole frame into one
task.  Two ways around it:

* ``bucketed_position``: rows in earlier buckets + position inside the bucket.
  The rows are windowed per bucket and only the bucket sizes per key; good
  where a key has few dense buckets (row blocks of a frame, splits of a file).
* ``ranged_position``: a range sort of everything; a position is the rows of
  earlier partitions + the place in the partition.  Good for any order and for
  keys that hold most of the rows.
* ``keyed_position``: a window per key where keys are short, the range sort for
  the long ones only.  One shuffle by key, which later steps on the key use too.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.operators.joins import join_keys
from trajlake.session import cut_lineage

LONG = 1_000_000  # rows of a key that one task sorts


def bucket_offsets(df: DataFrame, keys: Sequence[str], buckets: Sequence[str],
                   out: str) -> DataFrame:
    """(keys, buckets, out): number of rows of the key in earlier buckets."""
    sizes = df.groupBy(*keys, *buckets).agg(F.count(F.lit(1)).alias("_size"))
    before = (W.partitionBy(*keys).orderBy(*buckets)
              .rowsBetween(W.unboundedPreceding, -1))
    return sizes.select(*keys, *buckets,
                        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias(out))


def bucketed_position(df: DataFrame, keys: Sequence[str], buckets: Mapping[str, Column],
                      order: Sequence[Column], out: str) -> DataFrame:
    """Add the 0-based position in ``keys`` ordered by (buckets, order).

    ``buckets`` must be non-null and agree with ``order`` (every row of an
    earlier bucket sorts first).
    """
    names = list(buckets)
    df = df.withColumns(dict(buckets))
    inside = W.partitionBy(*keys, *names).orderBy(*order)
    offsets = bucket_offsets(df, keys, names, "_before")
    return (df.withColumn("_inside", F.row_number().over(inside) - 1)
            .join(offsets, [*keys, *names])
            .withColumn(out, (F.col("_before") + F.col("_inside")).cast("bigint"))
            .drop("_before", "_inside", *names))


def ranged_position(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Add the 0-based position in ``keys`` (none: the whole table) by ``order``.

    The sorted rows are stored, so partition numbers and places stay what
    they were when the offsets were counted.
    """
    # an expression in a sort is formed anew in every comparison
    places = {f"_o{i}": c for i, c in enumerate(order)}
    everything = [F.col(c) for c in (*keys, *places)]
    rows = cut_lineage(df.withColumns(places).repartitionByRange(*everything).sortWithinPartitions(*everything).drop(*places)
                       .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    # one row per partition
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = rows.join(F.broadcast(parts), "_part").withColumn("_place", F.col("_row") + F.col("_shift"))
    if keys:
        starts = placed.groupBy(*keys).agg(F.min("_place").alias("_start"))
        placed = join_keys(placed, starts, keys).withColumn("_place", F.col("_place") - F.col("_start")).drop("_start")
    return placed.withColumn(out, F.col("_place").cast("bigint")).drop("_part", "_row", "_shift", "_place")


def keyed_position(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, long: int = LONG) -> DataFrame:
    """Like ``ranged_position`` for an ``order`` that leaves no ties between different rows.

    Keys of up to ``long`` rows are sorted by one task each (which may spill);
    only longer ones are spread by range.  Nothing is stored for short keys, so
    the positions are formed anew by each use.
    """
    inside = W.partitionBy(*keys).orderBy(*order)
    hot = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > long).drop("_n"))
    if hot.isEmpty():
        return df.withColumn(out, (F.row_number().over(inside) - 1).cast("bigint"))
    short = join_keys(df, hot, keys, "left_anti").withColumn(out, (F.row_number().over(inside) - 1).cast("bigint"))
    return short.unionByName(ranged_position(join_keys(df, hot, keys, "left_semi"), keys, order, out))


def even_picks_truncating(position_col: Column, n: Column, picks: int) -> Column:
    """True where the position is one of ``int(linspace(0, n-1, picks))``.

    The pick ``i`` sits at ``floor(i * step)``, so a position ``p`` can only be
    hit by the two candidates around ``p / step``.
    """
    if picks <= 1:
        return position_col == 0
    step = (n - 1) / F.lit(float(picks - 1))
    guess = F.ceil(F.try_divide(position_col, step))
    hit = F.lit(False)
    for i in (guess - 1, guess, guess + 1):
        hit = hit | ((i >= 0) & (i <= picks - 1) & (_linspace_index(i, n, picks, step) == position_col))
    return F.when(n <= picks, F.lit(True)).otherwise(hit)


def _linspace_index(i: Column, n: Column, picks: int, step: Column) -> Column:
    # the last point of a linspace is the end point itself, not i * step
    return F.when(i == picks - 1, n - 1).otherwise(F.floor(i * step))


def even_picks_rounding(position_col: Column, n: Column, picks: Column) -> Column:
    """True where the position is ``round(i * (n-1)/(picks-1))`` for some i.

    ``picks`` <= 0 selects nothing, 1 selects the middle, >= n selects all.
    """
    step = F.try_divide(n - 1, picks - 1)
    guess = F.rint(F.try_divide(position_col, step))
    hit = F.lit(False)
    for i in (guess - 1, guess, guess + 1):
        hit = hit | ((i >= 0) & (i <= picks - 1) & (F.rint(i * step) == position_col))
    return (F.when(n <= picks, F.lit(True)).when(picks <= 0, F.lit(False))
            .when(picks == 1, position_col == F.floor(n / 2)).otherwise(hit))
