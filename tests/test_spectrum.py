"""The angular spectrum against sums of Legendre polynomials, and what must not change it."""
import numpy as np
import pytest

from trajlake.operators import descriptors as D
from trajlake.operators.neighbors import with_position

SIDE = 60.0
SCHEMA = "frame long, row_idx long, id long, type int, x double, y double, z double, lx double, ly double, lz double"
RCUT, N, L = 4.0, 3, 4


def frames_of(spark, frames):
    rows = [(f, r, r + 1, int(t), *map(float, p), SIDE, SIDE, SIDE) for f, (types, at) in frames.items() for r, (t, p) in enumerate(zip(types, at))]
    return with_position(spark.createDataFrame(rows, SCHEMA)).repartition(3)


def spectra(spark, frames):
    out = {}
    for r in D.angular_spectrum(frames_of(spark, frames), ["frame"], RCUT, N, L).collect():
        out[r["frame"], r["type_i"]] = np.array(r["features"])
    return out


def by_pairs(types, at):
    """Sums over pairs of neighbours, by the addition theorem: no harmonics."""
    factors = np.array(D.radial_basis(N, RCUT))
    out = {}
    for i in range(len(at)):
        d = at - at[i]
        d -= np.rint(d / SIDE) * SIDE
        r = np.sqrt((d * d).sum(axis=1))
        near = np.flatnonzero((r <= RCUT) & (np.arange(len(at)) != i))
        unit = np.where(r[near, None] > 0, d[near] / np.where(r[near, None] > 0, r[near, None], 1), 0)
        g = np.array([sum(f * (RCUT - r[near]) ** (a + 3) for a, f in enumerate(row)) for row in factors])
        cos = unit @ unit.T
        some = np.outer(r[near] > 0, r[near] > 0)
        legendre = [(2 * l + 1) / (4 * np.pi) * np.polynomial.legendre.Legendre.basis(l)(cos) * (some if l else 1) for l in range(L + 1)]
        own = [(g[n] * (types[near] == t)) @ legendre[l] @ (g[o] * (types[near] == u)) for t, n, u, o, l in D.spectrum_slots(N, L)]
        if len(near):
            out[int(types[i])] = out.get(int(types[i]), 0) + np.array(own) / len(at)
    return out


def some_atoms(seed, n=40):
    rng = np.random.default_rng(seed)
    types, at = rng.integers(1, 3, n), rng.normal(size=(n, 3)) * 2.5 + 30
    at[5] = at[6] = at[7]  # three in one place
    return types, at


def test_radial_functions_are_orthonormal():
    r = np.linspace(0, RCUT, 200_001)
    g = np.array([sum(f * (RCUT - r) ** (a + 3) for a, f in enumerate(row)) for row in D.radial_basis(4, RCUT)])
    assert np.allclose(np.trapezoid(g[:, None] * g, r, axis=2), np.eye(4), atol=1e-6)


def test_harmonics_are_orthonormal():
    z, weight = np.polynomial.legendre.leggauss(12)
    angle = np.arange(24) * 2 * np.pi / 24
    x, y = (np.sqrt(1 - z * z)[:, None] * f(angle) for f in (np.cos, np.sin))
    values = np.array([np.broadcast_to(v, x.shape) for own in D.real_harmonics(x, y, np.broadcast_to(z[:, None], x.shape), 5) for v in own])
    assert np.allclose(np.einsum("aij,bij,i->ab", values, values, weight * 2 * np.pi / 24), np.eye(36), atol=1e-12)


def test_same_as_sums_over_pairs_of_neighbours(spark):
    frames = {0: some_atoms(1), 1: some_atoms(2, 17), 2: (np.array([1, 2]), np.array([[1.0, 1, 1], [30, 30, 30]])),
              3: (np.array([1, 2, 3]), np.array([[1.0, 1, 1], [59.5, 1, 1], [1, 2, 1]]))}
    got = spectra(spark, frames)
    want = {(f, t): v for f, (types, at) in frames.items() for t, v in by_pairs(types, at).items()}
    assert set(got) == set(want)
    for key, v in want.items():
        assert np.allclose(got[key], v, rtol=1e-9, atol=1e-9)


def test_turned_moved_and_relabelled_frames_look_alike(spark):
    types, at = some_atoms(3)
    rng = np.random.default_rng(4)
    turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    order = rng.permutation(len(at))
    frames = {0: (types, at), 1: (types, (at - 30) @ turn + 30), 2: (types, np.mod(at + [35, 41, -28], SIDE)), 3: (types[order], at[order]),
              4: (types, at * [1.02, 1, 1] - [0.6, 0, 0])}
    got = spectra(spark, frames)
    for f in (1, 2, 3):
        for t in (1, 2):
            assert np.allclose(got[f, t], got[0, t], rtol=1e-8, atol=1e-8)
    assert not np.allclose(got[4, 1], got[0, 1], rtol=1e-4, atol=1e-4)


def test_vectors_of_frames_without_neighbours_are_zero(spark):
    frames = {0: some_atoms(5, 9), 1: (np.array([1, 2]), np.array([[1.0, 1, 1], [30, 30, 30]]))}
    atoms = frames_of(spark, frames)
    names = atoms.select("frame").distinct()
    rows = D.spectrum_vectors(names, D.angular_spectrum(atoms, ["frame"]), ["frame"]).collect()
    assert len({len(r["features"]) for r in rows}) == 1 and len(rows) == 2
    by_frame = {r["frame"]: r["features"] for r in rows}
    assert not any(by_frame[1]) and any(by_frame[0])
    assert D.angular_spectrum(atoms.limit(0), ["frame"]).count() == 0
    with pytest.raises(ValueError):
        from trajlake.plans.analysis import analyse_structures
        analyse_structures(names, atoms.withColumn("c_pe", atoms.x), "other")
