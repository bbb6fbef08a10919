"""Whole jobs on small files."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.operators.beads import BeadRules
from trajlake.plans.analysis import (analyse_structures, attach_frames, load_structures, profile_dataset, select_structures,
                                     write_picks)
from trajlake.plans.checks import audit_files, exit_code, pressure_temperature, score_predictions
from trajlake.plans.coarse_graining import coarse_grain_dumps, run_counters, warning_rollup
from trajlake.plans.training_sets import training_rows, write_training_set
from trajlake.sinks import tables as K
from trajlake.sinks.dumps import bead_dump_lines, write_dump
from trajlake.sources import catalog, tables
from trajlake.sources.dump import read_atoms

RULES = BeadRules(patterns=((1, 2, 2),), r_cutoff=1.3, unwrap_pbc=True)


def chain_file(path, steps, n_units=6, seed=0, box=9.0):
    """A CH2 chain through a periodic box, ids along the chain."""
    rng = np.random.default_rng(seed)
    out = []
    for step in steps:
        lines = []
        for u in range(n_units):
            c = np.array([1.6 * u, 4.0, 4.0]) + rng.normal(0, 0.05, 3)
            for k, p in enumerate((c, c + [0, 0.9, 0.3], c + [0, -0.9, 0.3])):
                f = rng.normal(size=3)
                w = p % box
                lines.append(f"{3 * u + k + 1} {1 if k == 0 else 2} {w[0]} {w[1]} {w[2]} {f[0]} {f[1]} {f[2]} {rng.normal()}")
        out.append("\n".join(["ITEM: TIMESTEP", str(step), "ITEM: NUMBER OF ATOMS", str(3 * n_units), "ITEM: BOX BOUNDS pp pp pp",
                              *[f"0 {box}"] * 3, "ITEM: ATOMS id type x y z fx fy fz c_pe", *lines]))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(out) + "\n")


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    root = tmp_path_factory.mktemp("aa")
    for t in (200, 300):
        for k, step in enumerate((1000, 2000)):
            chain_file(root / "1-npt" / str(t) / f"NPT.{t}.{step}", [step, step + 10], seed=t + k)
    chain_file(root / "3-upT" / "traj" / "upT.500", [500, 510, 520], seed=9)
    (root / "3-upT" / "traj" / "notes.txt").write_text("hello")
    (root / "1-npt" / "log.lammps").write_text("Step Temp Press\n1000 201 1.5\n2000 199 2.5\nLoop time\nStep Temp Press\n1000 303 3.5\n2000 301 4.5\nLoop time\n")
    return root


@pytest.fixture(scope="module")
def coarse(spark, data):
    sims = [{"name": "1-npt", "trajectory_dir": "1-npt/{temp}", "file_pattern": "NPT.{temp}.*", "temperatures": [200, 300]},
            {"name": "3-upT", "trajectory_dir": "3-upT/traj", "file_pattern": "upT.*", "temperatures": None},
            {"name": "off", "enabled": False, "trajectory_dir": "x", "file_pattern": "y"}]
    listed = catalog.globs(catalog.enabled(sims), str(data))
    assert catalog.list_files(spark, listed).count() == 5
    return coarse_grain_dumps(spark, [p for _, _, p in listed], RULES)


def test_coarse_graining(spark, coarse):
    beads = coarse.beads.orderBy("file", "frame_idx", "id").collect()
    assert len(beads) == 11 * 6 and {b["n_atoms"] for b in beads} == {3}
    assert [b["atom_indices"] for b in beads[:2]] == [[0, 1, 2], [3, 4, 5]] or all(len(b["atom_indices"]) == 3 for b in beads)
    counts = {r["sim_type"]: (r["total_files"], r["success"], r["total_frames"], r["total_beads"]) for r in run_counters(coarse.outcomes).collect()}
    assert counts == {"1-npt": (4, 4, 8, 48), "3-upT": (1, 1, 3, 18)}
    assert coarse.boxes.count() == 11 and coarse.boxes.first()["cell"][4] == 9.0
    assert warning_rollup(coarse.warnings).count() == 0


def test_bead_files_round_trip(spark, coarse, tmp_path):
    K.write_beads(coarse.beads, str(tmp_path / "p"), ["sim_type", "temp"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 66
    K.write_beads(coarse.beads.drop("frame_idx", "sim_type", "temp"), str(tmp_path / "b"), fmt="csv")
    back = tables.read_beads_csv(spark, str(tmp_path / "b"))
    key = ["timestep", "id", "x", "fx", "atom_indices", "match_status", "manual_assignment", "pattern"]
    assert sorted(map(str, back.select(key).collect())) == sorted(map(str, coarse.beads.select(key).collect()))
    K.write_boxes(coarse.boxes.select("timestep", "cell"), str(tmp_path / "x"), fmt="csv")
    box = tables.read_boxes_csv(spark, str(tmp_path / "x"))
    assert box.count() == 11 and box.first()["cell"][8] == 9.0


def test_training_set(spark, coarse, tmp_path):
    rows = training_rows(coarse.beads, coarse.boxes, num_sets=3)
    write_training_set(rows, str(tmp_path))
    coord = [np.load(tmp_path / "1-npt" / "200" / "n6" / f"set.{g:03d}" / "coord.npy") for g in range(3)]
    assert [len(c) for c in coord] == [2, 1, 1] and coord[0].shape == (2, 18)
    energy = np.load(tmp_path / "1-npt" / "200" / "n6" / "set.000" / "energy.npy")
    atom = np.load(tmp_path / "1-npt" / "200" / "n6" / "set.000" / "atom_ener.npy")
    assert energy.shape == (2,) and np.allclose(atom.sum(1), energy)
    first = coarse.beads.where("sim_type = '1-npt' and temp = 200 and timestep = 1000").orderBy("id").collect()
    assert np.allclose(coord[0][0][:3], [first[0]["x"], first[0]["y"], first[0]["z"]])
    text = spark.read.text(f"{tmp_path}/coord.raw/sim_type=1-npt/temp=200").collect()
    assert len(text) == 4 and len(text[0][0].split(" ")) == 18 and text[0][0].split(" ")[0] == f"{first[0]['x']:.8f}"
    assert spark.read.text(f"{tmp_path}/type_map.raw/sim_type=3-upT").first()[0] == "CG0"
    assert np.load(tmp_path / "3-upT" / "ramp" / "n6" / "set.000" / "box.npy").shape == (1, 9)


def test_audit(spark, coarse, data):
    dumps = [str(data / "1-npt" / "*" / "NPT.*"), str(data / "3-upT" / "traj" / "upT.*")]
    sources = coarse.beads.select(F.col("file").alias("bead_file"), F.col("file").alias("source")).distinct()
    clean = audit_files(spark, coarse.beads, sources, dumps, RULES)
    assert clean.issues.count() == 0 and exit_code(clean.files) == 0
    assert clean.worst.agg(F.max("worst_force_err")).first()[0] < 1e-9
    hurt = coarse.beads.withColumn("fx", F.when(F.col("timestep") == 510, F.col("fx") + 1).otherwise(F.col("fx")))
    found = audit_files(spark, hurt, sources, dumps, RULES)
    assert found.issues.select("check", "severity", "sim").distinct().collect() == [("conservation", "FAIL", "3-upT")]
    assert exit_code(found.files) == 1 and K.audit_report(found.issues).columns == list(K.REPORT_COLUMNS)
    late = coarse.beads.withColumn("timestep", F.when(F.col("timestep") == 520, 521).otherwise(F.col("timestep")))
    bad = audit_files(spark, late, sources, dumps, RULES).files
    assert exit_code(bad) == 2 and bad.where("status = 'BAD'").count() == 1


def test_profile(spark, coarse):
    p = profile_dataset(coarse.beads)
    assert p.files.count() == 5
    total = p.rollup.where("level = 'all'").first()
    assert (total["n_particles"], total["n_frames"], total["n_files"]) == (66, 11, 5)
    mags = np.array([np.sqrt(r.fx ** 2 + r.fy ** 2 + r.fz ** 2) for r in coarse.beads.collect()])
    assert total["force_mean"] == pytest.approx(mags.mean()) and total["force_std_pooled"] == pytest.approx(mags.std(ddof=1))
    assert {r["temp"] for r in p.by_temperature.collect()} == {200, 300}


def test_pressure_temperature(spark, data):
    rows = pressure_temperature(spark, [str(data / "1-npt" / "*" / "NPT.*"), str(data / "3-upT" / "traj" / "upT.*")],
                                [str(data / "*" / "log.lammps")], str(data))
    got = {(r["sim_type"], r["temp_nominal"], r["timestep"]): r["pressure"] for r in rows.collect()}
    assert got == {("1-npt", 200, 1000): 1.5, ("1-npt", 200, 2000): 2.5, ("1-npt", 300, 1000): 3.5, ("1-npt", 300, 2000): 4.5,
                   ("3-upT", None, 500): None}
    some = pressure_temperature(spark, [str(data / "1-npt" / "*" / "NPT.*")], [str(data / "*" / "log.lammps")], str(data),
                                sims=["1-npt"], temps=[300], max_frames=1)
    assert some.count() == 1 and some.first()["temp_nominal"] == 300


def test_analysis_and_selection(spark, data, tmp_path):
    root = tmp_path / "in"
    for s in ("a", "b"):
        for k in range(8):
            chain_file(root / s / "200" / f"f.{k}_cg.lammpstrj", [k * 10], seed=k if s == "a" else 100 + k)
    frames, atoms = load_structures(spark, [str(root / "*" / "*" / "*_cg.lammpstrj")])
    assert frames.count() == 16
    out = analyse_structures(frames, atoms, components=4, method="kmeans", n_clusters=2)
    assert out.table.count() == 16 and out.table.select("id").distinct().count() == 16
    assert out.variance == sorted(out.variance, reverse=True)
    dense = analyse_structures(frames, atoms, descriptor="density", components=3, min_samples=2)
    assert dense.table.where("cluster is null").count() == 0
    picks = select_structures(out.table, 2, n_clusters=3)
    assert picks.count() == sum(min(2, r["n"]) for r in picks.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect())
    extra = picks.limit(1).withColumns({"source_file": F.lit(str(tmp_path / "gone")), "structure_id": F.lit("x/1@5")})
    manifest, found = attach_frames(picks.unionByName(extra))
    states = {r["status"]: r["n"] for r in manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert states == {"written": picks.count(), "source missing": 1}
    write_picks(found, str(tmp_path / "sel"))
    again = read_atoms(spark, str(tmp_path / "sel" / "*"))
    assert again.select("file").distinct().count() == picks.select("structure_id").distinct().count()
    assert K.selection_manifest(manifest, ["PC1"]).columns[0] == "structure_id"


def test_scoring(spark, tmp_path):
    rng = np.random.default_rng(0)
    for d in ("p", "r"):
        (tmp_path / d).mkdir()
    ref = rng.normal(size=(6, 9))
    np.save(tmp_path / "r" / "force.npy", ref)
    np.savetxt(tmp_path / "p" / "force.raw", ref[:5] + 0.1, fmt="%.17g")
    np.save(tmp_path / "r" / "energy.npy", np.arange(6.0))
    np.save(tmp_path / "p" / "energy.npy", np.arange(6.0) * 2)
    rows = {r["quantity"]: r for r in score_predictions(spark, str(tmp_path / "p"), str(tmp_path / "r")).collect()}
    assert rows["force"]["rmse"] == pytest.approx(0.1) and rows["force"]["n_frames"] == 5
    assert rows["energy"]["mae"] == pytest.approx(2.5)
    few = {r["quantity"]: r["n_frames"] for r in score_predictions(spark, str(tmp_path / "p"), str(tmp_path / "r"), 3).collect()}
    assert few == dict.fromkeys(("force", "force_x", "force_y", "force_z", "energy"), 3)


def test_catalog(spark, data, coarse, tmp_path):
    names = {r["file"].rsplit("/", 1)[-1] for r in catalog.find_dumps(spark, str(data)).collect()}
    assert names == {"NPT.200.1000", "NPT.200.2000", "NPT.300.1000", "NPT.300.2000", "upT.500"}
    assert catalog.fill_template("a/{temp}/b", None) == "a/b" and catalog.fill_template("a/{temp}", 5) == "a/5"
    beads = coarse.beads.where("sim_type = '3-upT'").withColumn("name", F.lit("upT.500_cg.lammpstrj"))
    boxes = coarse.boxes.join(beads.select("file", "frame_idx").distinct(), ["file", "frame_idx"]).withColumn("name", F.lit("upT.500_cg.lammpstrj"))
    write_dump(bead_dump_lines(beads, boxes, ["name", "frame_idx"]), str(tmp_path / "cg"), "name", ["frame_idx"])
    assert read_atoms(spark, str(tmp_path / "cg" / "*")).count() == 18
    bead_files = spark.createDataFrame([("/o/NPT.200.1000_particles.csv", "1-npt", 200), ("/o/none_particles.csv", "1-npt", 200)], "file string, sim string, temp int")
    dumps = spark.createDataFrame([("/a/z/NPT.200.1000",), ("/a/b/NPT.200.1000",)], "file string")
    folders = spark.createDataFrame([("1-npt", 200, 0, "/a/z")], "sim string, temp int, priority int, folder string")
    got = {r["bead_file"]: r["source"] for r in catalog.resolve_sources(bead_files, dumps, folders).collect()}
    assert got == {"/o/NPT.200.1000_particles.csv": "/a/z/NPT.200.1000", "/o/none_particles.csv": None}
    got = {r["bead_file"]: r["source"] for r in catalog.resolve_sources(bead_files, dumps).collect()}
    assert got["/o/NPT.200.1000_particles.csv"] == "/a/b/NPT.200.1000"
