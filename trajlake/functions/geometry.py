"""Periodic geometry as plain column expressions.

All rounding is half-even (``rint``); ``F.round`` would round half up.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: Boltzmann constant in eV/K (CODATA 2018).
BOLTZMANN_EV_PER_K = 8.617333262e-5


def min_image(delta: Column, length: Column) -> Column:
    """Fold a difference into the nearest periodic image (NULL for a box of no length)."""
    return delta - F.rint(F.try_divide(delta, length)) * length


def pbc_abs_diff(a: Column, b: Column, length: Column) -> Column:
    """|a - b| under the minimum image; a vanishing box length means no folding."""
    delta = a - b
    return F.when(F.abs(length) < 1e-12, F.abs(delta)).otherwise(
        F.abs(min_image(delta, length)))


def squared_distance(left: list[Column], right: list[Column], lengths: list[Column]) -> Column:
    """Squared minimum-image distance between two points."""
    total = None
    for a, b, length in zip(left, right, lengths):
        d = min_image(b - a, length)
        total = d * d if total is None else total + d * d
    return total


def cell9(lx: Column, ly: Column, lz: Column) -> Column:
    """The diagonal 3x3 cell as nine doubles."""
    zero = F.lit(0.0)
    return F.array(lx, zero, zero, zero, ly, zero, zero, zero, lz)


def magnitude(fx: Column, fy: Column, fz: Column) -> Column:
    return F.sqrt(fx * fx + fy * fy + fz * fz)


def centered(atoms: DataFrame, frame: Sequence[str], axes: Sequence[str] = ("px", "py", "pz")) -> DataFrame:
    """Positions relative to the mean position of their frame.

    The means are one row per frame, so a hot frame only meets a single row.
    """
    means = atoms.groupBy(*frame).agg(*[F.avg(a).alias(f"_mean_{a}") for a in axes])
    return atoms.join(means, list(frame)).withColumns(
        {a: F.col(a) - F.col(f"_mean_{a}") for a in axes}).drop(*[f"_mean_{a}" for a in axes])


def kelvin_to_ev(kelvin: Column) -> Column:
    return kelvin * F.lit(BOLTZMANN_EV_PER_K)


def round_to(value: Column, digits: int) -> Column:
    return F.round(value, digits)


def is_finite(value: Column) -> Column:
    """True for values that are neither NULL, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
