"""Frames of few atoms: no growing cutoffs, no components, no cells; the results are those of the long way."""
import random

import pytest
from pyspark.sql import functions as F

from tests.test_beads import RULES, atoms_of, compare, random_frames
from trajlake.operators import beads as B
from trajlake.operators import descriptors as D
from trajlake.operators import neighbors


def refuse(*_):
    raise AssertionError("not for short frames")


@pytest.mark.parametrize("name", ["no cutoff", "cutoff"])
def test_short_frames_are_decided_at_once(spark, monkeypatch, name):
    monkeypatch.setattr(B, "connected_components", refuse)
    if name == "no cutoff":
        monkeypatch.setattr(B, "_growing_cutoff", refuse)
    compare(spark, random_frames(6, (12, 60), 3), RULES[name])


def test_long_and_short_frames_together(spark, monkeypatch):
    """Some frames by growing cutoffs and components, some at once."""
    monkeypatch.setattr(B, "ATOM_PAIRS", 6)
    monkeypatch.setattr(B, "FRAME_PAIRS", 150)
    compare(spark, random_frames(6, (8, 60), 4), RULES["no cutoff"])


def test_cells_follow_the_largest_frame(spark):
    """A frame of few atoms is one cell, so a center is not sent to 27; pairs by brute force either way."""
    rng, box = random.Random(2), (30.0, 20.0, 25.0)
    points = [(i, *[rng.uniform(0, b) for b in box]) for i in range(200)]
    atoms = spark.createDataFrame([(0, i, x, y, z, *box) for i, x, y, z in points],
                                  "frame long, row_idx long, px double, py double, pz double, lx double, ly double, lz double")
    others = atoms.withColumnRenamed("row_idx", "other")
    want = sorted((a[0], b[0]) for a in points for b in points
                  if sum((u - v - round((u - v) / l) * l) ** 2 for u, v, l in zip(a[1:], b[1:], box)) <= 9)
    for crowd in (10, neighbors.largest_frame(atoms, ["frame"]), None):
        pairs = neighbors.cell_pairs(atoms, others, ["frame"], 3.0, crowd=crowd)
        assert sorted((r["row_idx"], r["other"]) for r in pairs.collect()) == want
    counts = neighbors._with_cells(atoms, F.lit(3.0), 10).agg(*[F.max(f"_n{i}") for i in range(3)]).first()
    assert tuple(counts) == (1, 1, 1)
    seen = D.angular_spectrum(atoms_of(spark, random_frames(3, 20, 1)), ["frame"])._jdf.queryExecution().optimizedPlan().toString()
    assert "least(" in seen
