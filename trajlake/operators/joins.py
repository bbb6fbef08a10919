"""Equi-joins that treat NULL keys as equal (ramps have no temperature)."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Like ``left.join(right, keys, how)`` with ``<=>``; keys come from the left."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    out = left.join(renamed, same, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])
