"""Thermo logs, nearest-block lookup, labels, matrices, file names."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.functions import metadata as M
from trajlake.functions import text as X
from trajlake.operators.thermo import join_thermo
from trajlake.plans.training_sets import labels_for_boxes, measured_labels, write_labels
from trajlake.sinks.training import label_text
from trajlake.sources.matrix import read_matrix, read_npy, read_raw
from trajlake.sources.thermo import read_thermo

LOG = """header text
Step Temp Press
0 200 1.0
WARNING: something
100 210 2.0
100 220 bad
Loop time of 1
Step Temp Press Lx
0 500 9
-5 510 9 7.5

Steps of nothing Temp
Step Press
7 3
Step Temp
8 4
Loop time
Step Temp Press
1 300 5
"""


@pytest.mark.parametrize("split", ["64", "1000000"])
def test_blocks(spark, tmp_path, split):
    (tmp_path / "log.lammps").write_text(LOG)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        rows = read_thermo(spark, str(tmp_path / "log.lammps")).orderBy("block_id", "first_line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = [(r["block_id"], r["step"], r["temp"], r["press"], r["lx"]) for r in rows]
    assert got == [(0, 0, 200.0, 1.0, None), (0, 100, 220.0, None, None), (1, 0, 500.0, 9.0, None), (1, -5, 510.0, 9.0, 7.5),
                   (2, 7, None, 3.0, None), (2, 8, None, 4.0, None), (3, 1, 300.0, 5.0, None)]
    assert rows[1]["first_line"] == 4 and rows[1]["line_no"] == 5


def test_measured_labels_in_log_order(spark, tmp_path):
    (tmp_path / "log.lammps").write_text(LOG)
    rows = measured_labels(spark, str(tmp_path / "log.lammps"), "K").orderBy("file", "block_id", "first_line").collect()
    assert [r["fparam"] for r in rows] == [200.0, 220.0, 500.0, 510.0, 300.0]


def test_label_files(spark, tmp_path):
    (tmp_path / "log.lammps").write_text(LOG)
    rows = measured_labels(spark, str(tmp_path / "log.lammps"), "K").withColumn("sim", F.lit("3-upT"))
    write_labels(rows, str(tmp_path / "out"), ["sim"], ["block_id", "first_line"])
    assert np.load(tmp_path / "out" / "3-upT" / "set.000" / "fparam.npy").tolist() == [200.0, 220.0, 500.0, 510.0, 300.0]
    text = [r[0] for r in spark.read.text(str(tmp_path / "out" / "fparam.raw" / "sim=3-upT")).collect()]
    assert text == ["200", "220", "500", "510", "300"]


def test_constant_labels(spark, tmp_path):
    (tmp_path / "box.raw").write_text("1 2 3\n\n4 5 6\n   \n7 8 9")
    rows = labels_for_boxes(spark, str(tmp_path / "box.raw"), 300.0).orderBy("frame_no").collect()
    assert [r["frame_no"] for r in rows] == [0, 1, 2]
    assert rows[0]["fparam"] == pytest.approx(300 * 8.617333262e-5)


def test_label_text(spark):
    values = [0.0, 0.02585199979, 300 * 8.617333262e-5, 300.0, 1.5, 123456.789, 1e-5, 12.3456789012345, -0.5]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", label_text(F.col("v")).alias("t"))
    for v, t in df.collect():
        assert t == f"{v:.10g}", v


def test_nearest_block(spark):
    thermo = spark.createDataFrame([("s", 0, 5, 200.0, 1.0), ("s", 0, 6, 220.0, 2.0), ("s", 1, 5, 300.0, 3.0), ("s", 2, 5, None, 4.0)],
                                   "sim string, block_id long, step long, temp double, press double")
    frames = spark.createDataFrame([("s", 5, 205), ("s", 5, 290), ("s", 5, None), ("s", 5, 400), ("s", 9, 205), ("t", 5, 205)],
                                   "sim string, step long, temp_nominal int")
    rows = {(r["sim"], r["step"], r["temp_nominal"]): (r["temp_measured"], r["pressure"]) for r in join_thermo(frames, thermo).collect()}
    assert rows[("s", 5, 205)] == (200.0, 1.0) and rows[("s", 5, 290)] == (300.0, 3.0)
    assert rows[("s", 5, None)] == (200.0, 1.0) and rows[("s", 5, 400)] == (None, None)
    assert rows[("s", 9, 205)] == (None, None) and rows[("t", 5, 205)] == (None, None)


def test_matrices(spark, tmp_path):
    a = np.arange(12, dtype="float32").reshape(4, 3)
    np.save(tmp_path / "force.npy", a)
    np.save(tmp_path / "energy.npy", np.array([1.5, 2.5]))
    (tmp_path / "force.raw").write_text("9 9 9\n")
    (tmp_path / "other.raw").write_text("1 2\n\n3 4\n")
    rows = read_matrix(spark, str(tmp_path), "force").orderBy("frame_no").collect()
    assert [r["values"] for r in rows] == a.tolist()
    assert [r["values"] for r in read_npy(spark, str(tmp_path / "energy.npy")).orderBy("frame_no").collect()] == [[1.5], [2.5]]
    assert [r["values"] for r in read_raw(spark, str(tmp_path / "other.raw")).orderBy("frame_no").collect()] == [[1.0, 2.0], [3.0, 4.0]]
    with pytest.raises(FileNotFoundError):
        read_matrix(spark, str(tmp_path), "none")


def test_npy_in_chunks(spark, tmp_path, monkeypatch):
    a = np.random.default_rng(0).normal(size=(50_000, 200))  # 80 MB: several chunks
    np.save(tmp_path / "v.npy", a)
    got = read_npy(spark, str(tmp_path / "v.npy")).select("frame_no", F.col("values")[7].alias("v"), F.size("values").alias("n"))
    pdf = got.orderBy("frame_no").toPandas()
    assert len(pdf) == 50_000 and (pdf["n"] == 200).all() and np.array_equal(pdf["v"], a[:, 7])


def test_path_labels(spark):
    cases = {
        "/d/1-npt/traj/NPT.200.100000": ("1-npt", None), "/d/1-npt/200/NPT.200.100000": ("1-npt", 200),
        "/d/1-npt/200/traj/x": ("1-npt", 200), "/d/x/NPT.200.100000": ("x", 200), "/d/3-upT/traj/upT.5000": ("3-upT", None),
        "/d/y/plain": ("y", None)}
    df = spark.createDataFrame([(k,) for k in cases], "p string").select("p", M.dump_labels(F.col("p")).alias("l"))
    assert {r["p"]: (r["l"]["sim_type"], r["l"]["temp"]) for r in df.collect()} == cases
    beads = {"/d/1-npt/200/f_cg.lammpstrj": ("1-npt", 200), "/d/3-upT/f_cg.lammpstrj": ("3-upT", None)}
    df = spark.createDataFrame([(k,) for k in beads], "p string").select("p", M.bead_dump_labels(F.col("p")).alias("l"))
    assert {r["p"]: (r["l"]["sim_type"], r["l"]["temp"]) for r in df.collect()} == beads
    tables = {"/b/1-npt/200/NPT.300.5_particles.csv": ("1-npt", 300), "/b/2-nvt/400/a_particles.csv": ("2-nvt", 400),
              "/b/3-upT/upT.5000_particles.csv": ("3-upT", None)}
    df = spark.createDataFrame([(k,) for k in tables], "p string").select("p", M.bead_table_labels(F.col("p"), "/b").alias("l"))
    assert {r["p"]: (r["l"]["sim_type"], r["l"]["temp"]) for r in df.collect()} == tables
    logs = {"/l/sim/traj/a": "/l/sim", "/l/sim/200/b": "/l/sim", "/l/c": "/l", "/other/s/t/d": "/other/s"}
    df = spark.createDataFrame([(k,) for k in logs], "p string").select("p", M.log_folder(F.col("p"), "/l").alias("l"))
    assert {r["p"]: r["l"] for r in df.collect()} == logs


def test_names_and_cells(spark):
    row = spark.createDataFrame([("x/NPT.200.100000", "[1, 2, 3]", "True", "(4, 5)", "nonsense", "a b/c@1")],
                                "f string, l string, b string, t string, j string, s string").select(
        X.first_number(F.col("f")).alias("a"), X.first_number(F.col("f"), "last").alias("b"), X.int_list(F.col("l")).alias("c"),
        X.int_list(F.col("t")).alias("d"), X.int_list(F.col("j")).alias("e"), X.bool_cell(F.col("b")).alias("g"),
        X.bool_cell(F.lit(None).cast("string")).alias("h"), X.bool_cell(F.lit("1.0")).alias("i"), X.safe_name(F.col("s")).alias("k"),
        M.step_of_id(F.lit("sim/200@15")).alias("m"), M.step_of_id(F.lit("none")).alias("n"),
        M.structure_id(F.lit("s"), F.lit(None).cast("int"), F.lit(5)).alias("o")).first()
    assert (row.a, row.b, row.c, row.d, row.e) == (200, 100000, [1, 2, 3], [4, 5], [])
    assert (row.g, row.h, row.i, row.k, row.m, row.n, row.o) == (True, False, True, "a_b_c_1", 15, None, "s/ramp@5")


def test_natural_order_and_columns(spark):
    paths = ["/a/10-x/f", "/a/2-x/f", "/a/2-x/100/f", "/z", "/b"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").orderBy(M.natural_key(F.col("p")))
    assert [r["p"] for r in df.collect()] == ["/a/2-x/f", "/a/2-x/100/f", "/a/10-x/f", "/b", "/z"]
    cols = ["PC10", "PC2", "PC1", "tSNE1", "UMAP1", "temp"]
    assert M.projection_space(cols) == "pca" and M.projection_space(["tSNE1", "UMAP1"]) == "umap"
    assert M.feature_columns(cols, "pca") == ["PC1", "PC2", "PC10"]
    assert M.clustering_columns(["PC1", "PC2", "PC3", "PC4"], "umap") == ["PC1", "PC2", "PC3"]
    with pytest.raises(ValueError):
        M.projection_space(["temp"])
