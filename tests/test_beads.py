"""Bead rules against a plain sequential implementation on random frames."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.operators import beads as B
from trajlake.operators.neighbors import nearest_members, with_position
from trajlake.operators.unwrap import unwrap_chain

BOX = (10.0, 8.0, 9.0)
SCHEMA = ("frame long, row_idx long, id long, type int, x double, y double, z double, fx double, fy double, fz double, "
          "c_pe double, lx double, ly double, lz double")


def random_frames(n_frames, n_atoms, seed, center_share=0.35, grid=None):
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(n_frames):
        n = n_atoms if np.isscalar(n_atoms) else int(rng.integers(*n_atoms))
        ids = rng.permutation(n) + 1
        for r in range(n):
            pos = rng.random(3) * BOX
            if grid:
                pos = np.floor(pos / grid) * grid
            rows.append((f, r, int(ids[r]), 1 if rng.random() < center_share else 2, *map(float, pos),
                         *map(float, rng.normal(size=4)), *BOX))
    return rows


def atoms_of(spark, rows):
    return with_position(spark.createDataFrame(rows, SCHEMA)).repartition(5)


def dist2(a, b):
    total = 0.0
    for k in range(3):
        d = b[k] - a[k]
        d -= np.rint(d / BOX[k]) * BOX[k]
        total += d * d
    return total


def sequential(rows, rules):
    """One frame after the other, one center after the other."""
    out = {}
    for f in sorted({r[0] for r in rows}):
        atoms = [r for r in rows if r[0] == f]
        by_id = {a[2]: a for a in atoms}
        used, beads = set(), []
        for ids, kind in rules.cg_assignments:
            got = [a[1] for a in atoms if a[2] in ids]
            if got and not used & set(got):
                used |= set(got)
                beads.append((kind, got))
        for _, types, offsets, kind in rules.valid_id_patterns():
            for a in atoms:
                if a[3] != rules.center_type or a[1] in used:
                    continue
                got = [by_id.get(a[2] + o) for o in offsets]
                if all(g is not None and g[3] == t and g[1] not in used for g, t in zip(got, types)):
                    beads.append((kind, [g[1] for g in got]))
                    used |= {g[1] for g in got}
        codes = rules.pattern_codes()
        free = [a for a in atoms if a[1] not in used]
        for a in free:
            if a[3] != rules.center_type or a[1] in used:
                continue
            near = sorted((dist2(a[4:7], m[4:7]), m[1]) for m in free if m[3] == 2 and m[1] not in used and m[1] != a[1])
            if rules.r_cutoff is not None:
                near = [x for x in near if x[0] <= rules.r_cutoff ** 2]
            best, score = None, -1
            for i, p in enumerate(rules.patterns):
                k = list(p).count(2)
                if len(near) >= k and 1 + k - 0.01 * len(p) > score:
                    best, score = i, 1 + k - 0.01 * len(p)
            if best is not None:
                got = [a[1]] + [m for _, m in near[:list(rules.patterns[best]).count(2)]]
                beads.append((codes[best], got))
                used |= set(got)
        out[f] = beads
    return out


def compare(spark, rows, rules):
    atoms = atoms_of(spark, rows)
    members, notes = B.assign_members(atoms, ["frame"], rules)
    beads = B.build_beads(members, atoms, ["frame"], rules).orderBy("frame", "id").collect()
    got = {}
    for b in beads:
        got.setdefault(b["frame"], []).append((b["type"], b["atom_indices"]))
    want = {f: v for f, v in sequential(rows, rules).items() if v}
    assert got == want
    return beads, notes


RULES = {
    "cutoff": B.BeadRules(patterns=((1, 2, 2), (1, 2, 2, 2)), r_cutoff=2.5),
    "few": B.BeadRules(patterns=((1, 2, 2), (1,), (1, 2)), r_cutoff=1.5),
    "explicit": B.BeadRules(r_cutoff=2.0, cg_assignments=(((1, 2, 3), 7), ((3, 4), 8), ((4, 5), 9), ((500,), 6))),
    "offsets": B.BeadRules(r_cutoff=2.0, id_patterns=(((1, 2), (0, 1), 5), ((1, 2, 2), (0, 2, -1), 6), ((2, 1), (0, 1), 4))),
    "shared type": B.BeadRules(patterns=((2, 2, 2), (2, 2)), center_type=2, r_cutoff=2.0),
    "no cutoff": B.BeadRules(patterns=((1, 2, 2), (1, 2))),
}


@pytest.mark.parametrize("name", list(RULES))
def test_same_as_sequential(spark, name):
    compare(spark, random_frames(6, (12, 60), 3), RULES[name])


def test_large_frame_without_cutoff_grows_one(spark):
    compare(spark, random_frames(1, 300, 5, 0.3), RULES["no cutoff"])


def test_coincident_atoms(spark):
    compare(spark, random_frames(3, 50, 8, grid=2.5), RULES["cutoff"])


def test_values_and_provenance(spark):
    rows = [(0, 0, 1, 1, 1.0, 1, 1, 1.0, 0, 0, 2.0, *BOX), (0, 1, 2, 2, 1.5, 1, 1, 14.0, 0, 0, 4.0, *BOX), (0, 2, 3, 2, 9.9, 1, 1, 0.0, 7.0, 0, 6.0, *BOX)]
    rows = [tuple(float(v) if i > 3 else v for i, v in enumerate(r)) for r in rows]
    beads, notes = compare(spark, rows, B.BeadRules(r_cutoff=1.5))
    b = beads[0]
    assert (b["x"], b["fx"], b["fy"], b["c_pe"], b["n_atoms"]) == (1.0, pytest.approx(26 / 14), pytest.approx(0.5), 4.0, 3)
    assert b["match_status"] == "pattern" and b["pattern"] == [1, 2, 2] and not b["manual_assignment"]
    assert notes.count() == 0
    beads, _ = compare(spark, rows, B.BeadRules(r_cutoff=1.5, average_forces=False, average_potential_energy=False))
    assert beads[0]["fx"] == 0.0 and beads[0]["c_pe"] is None
    beads, _ = compare(spark, rows, B.BeadRules(r_cutoff=1.5, force_energy_source="center_only"))
    assert beads[0]["fx"] == 1.0 and beads[0]["c_pe"] == 2.0
    beads, notes = compare(spark, rows, B.BeadRules(r_cutoff=1.5, cg_assignments=(((2, 1), 4),), id_patterns=(((1, 2), (0, 1), 3),)))
    assert beads[0]["assigned_atom_ids"] == [2, 1] and beads[0]["manual_assignment"] and beads[0]["match_status"] == "manual"
    beads, notes = compare(spark, rows, B.BeadRules(r_cutoff=0.1, id_patterns=(((1, 2, 2), (0, 1, 5), 3),)))
    assert beads == [] and {(r["reason"], r["bad_id"]) for r in notes.collect()} == {("missing", 6), ("no pattern", None)}
    assert len(B.BeadRules(id_patterns=(((1,), (0,), 1), ((1, 2), (1, 2), 1))).rule_warnings()) == 2


def loop_unwrap(rows):
    out = {}
    for f in {r[0] for r in rows}:
        atoms = sorted((r for r in rows if r[0] == f), key=lambda r: (r[2], r[1]))
        for k in range(3):
            vals = [a[4 + k] for a in atoms]
            for i in range(1, len(vals)):
                vals[i] -= np.rint((vals[i] - vals[i - 1]) / BOX[k]) * BOX[k]
            for a, v in zip(atoms, vals):
                out.setdefault((f, a[1]), []).append(v)
    return out


@pytest.mark.parametrize("block", [7, 65_536])
def test_unwrap_equals_loop(spark, block):
    rows = random_frames(5, (1, 80), 11)
    df = unwrap_chain(spark.createDataFrame(rows, SCHEMA), ["frame"], block)
    want = loop_unwrap(rows)
    got = {(r["frame"], r["row_idx"]): [r["x"], r["y"], r["z"]] for r in df.collect()}
    assert got.keys() == want.keys()
    for key in want:
        assert np.allclose(got[key], want[key], atol=1e-9)


def test_unwrap_keeps_frames_with_bad_box(spark):
    rows = [(*r[:11], 0.0, *r[12:]) for r in random_frames(1, 5, 1)]
    df = unwrap_chain(spark.createDataFrame(rows, SCHEMA), ["frame"])
    assert sorted(r["x"] for r in df.collect()) == sorted(r[4] for r in rows)


@pytest.mark.parametrize("types", [(1, 2), (2, 2)])
def test_nearest_members_with_copies(spark, types):
    rows = random_frames(2, 120, 21, grid=2.0)
    got = nearest_members(atoms_of(spark, rows), ["frame"], 2.5, 3, *types).collect()
    got = sorted((r["frame"], r["center_row"], r["rank"], r["member_row"]) for r in got)
    want = []
    for f in (0, 1):
        atoms = [r for r in rows if r[0] == f]
        for a in (r for r in atoms if r[3] == types[0]):
            near = sorted((dist2(a[4:7], m[4:7]), m[1]) for m in atoms if m[3] == types[1] and m[1] != a[1])
            want += [(f, a[1], i + 1, m) for i, (d, m) in enumerate([x for x in near if x[0] <= 6.25][:3])]
    assert got == sorted(want)
