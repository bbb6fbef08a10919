"""Chain unwrapping along the id order of a frame.

Each atom is shifted by whole box lengths so that it lies next to its
predecessor.  The shifts are integers, so the sequential rule is a running sum
of ``rint((raw - previous raw) / L)``.  The sum is taken per block of ids; the
block totals (one row per frame and block) carry the shift across blocks, so a
giant frame is spread over many tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

AXES = (("x", "lx"), ("y", "ly"), ("z", "lz"))


def unwrap_chain(atoms: DataFrame, frame: Sequence[str], block_rows: int = 65_536) -> DataFrame:
    """Overwrite x/y/z (and xu/yu/zu where present) with chain-continuous values."""
    frame = list(frame)
    axes = [(c, l) for c, l in AXES if c in atoms.columns]
    key = F.coalesce(F.col("id"), F.col("row_idx") + 1)
    rows = atoms.withColumns({"_key": key, "_block": F.floor(key / block_rows)})
    here = W.partitionBy(*frame, "_block").orderBy("_key", "row_idx")
    upto = here.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({
        f"_d_{c}": F.coalesce(F.rint(F.try_divide(F.col(c) - F.lag(c).over(here), F.col(l))), F.lit(0.0))
        for c, l in axes})
    rows = rows.withColumns({f"_k_{c}": F.sum(f"_d_{c}").over(upto) for c, _ in axes})

    # one row per block: its first and last raw value and its total shift
    at = F.struct("_key", "row_idx")
    blocks = rows.groupBy(*frame, "_block").agg(
        *[F.min_by(c, at).alias(f"_first_{c}") for c, _ in axes],
        *[F.max_by(c, at).alias(f"_last_{c}") for c, _ in axes],
        *[F.max_by(f"_k_{c}", at).alias(f"_total_{c}") for c, _ in axes],
        *[F.first(l).alias(f"_{l}") for _, l in axes])
    chain = W.partitionBy(*frame).orderBy("_block")
    chain_upto = chain.rowsBetween(W.unboundedPreceding, 0)
    blocks = blocks.withColumns({
        f"_step_{c}": F.coalesce(
            F.rint(F.try_divide(F.col(f"_first_{c}") - F.lag(f"_last_{c}").over(chain), F.col(f"_{l}")))
            + F.lag(f"_total_{c}").over(chain), F.lit(0.0))
        for c, l in axes})
    blocks = blocks.select(*frame, "_block",
                           *[F.sum(f"_step_{c}").over(chain_upto).alias(f"_carry_{c}") for c, _ in axes])

    rows = rows.join(blocks, [*frame, "_block"])
    valid = (F.col("lx") > 0) & (F.col("ly") > 0) & (F.col("lz") > 0)
    moved = {}
    for c, l in axes:
        value = F.when(valid, F.col(c) - (F.col(f"_k_{c}") + F.col(f"_carry_{c}")) * F.col(l)).otherwise(F.col(c))
        moved[c] = value
        if f"{c}u" in atoms.columns:
            moved[f"{c}u"] = F.when(F.col(c).isNull(), F.col(f"{c}u")).otherwise(value)
    return rows.withColumns(moved).select(*atoms.columns)
