"""Reading and writing atom dumps."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.sinks.dumps import bead_dump_lines, frame_dump_lines, write_dump
from trajlake.sources import dump as D


def frame_text(step, rows, columns="id type x y z", box=("0 10", "0 10", "0 10"), natoms=None, end="\n"):
    lines = ["ITEM: TIMESTEP", str(step), "ITEM: NUMBER OF ATOMS", str(len(rows) if natoms is None else natoms),
             "ITEM: BOX BOUNDS pp pp pp", *box, "ITEM: ATOMS " + columns, *rows]
    return end.join(lines) + end


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_sections_and_odd_frames(spark, tmp_path):
    text = (frame_text(0, ["1 1 1.5 2 3", "", "2 2 4 5 6", "3 2 9 9 9"], natoms=3)
            + "ITEM: TIMESTEP\n5\nITEM: NUMBER OF ATOMS\n1\nITEM: ATOMS id type x y z\n1 1 0 0 0\n"  # no box
            + frame_text(7, ["1 1 0 0 bad", "2 2 1 1"], natoms=5, box=("0 10 0.5", "-1 9 0", "0 10 0"))
            + frame_text(7, ["2 2 1 2 3 4 5 6 -0.25 7"], "id type x y z xu yu zu c_pe q"))
    path = write(tmp_path / "a", text)
    records = D.read_frames(spark, path)
    assert records.count() == 4 and records.where("ok").count() == 3
    frames = D.with_frame_idx(D.valid_frames(records))
    got = {r["frame_idx"]: (r["timestep"], r["natoms"]) for r in frames.collect()}
    assert got == {0: (0, 3), 1: (7, 5), 2: (7, 1)}
    atoms = D.read_atoms(spark, path, extra=True).orderBy("frame_idx", "row_idx").collect()
    # the blank line took a slot: two rows, numbered without a gap
    assert [(a["frame_idx"], a["row_idx"], a["id"], a["x"]) for a in atoms] == [
        (0, 0, 1, 1.5), (0, 1, 2, 4.0), (1, 0, 1, 0.0), (1, 1, 2, 1.0), (2, 0, 2, 1.0)]
    assert atoms[2]["z"] is None and atoms[3]["z"] is None and atoms[0]["xu"] is None
    assert atoms[4]["xu"] == 4.0 and atoms[4]["c_pe"] == -0.25 and atoms[4]["extra"] == {"q": 7.0}
    assert atoms[2]["ly"] == 10.0
    assert D.tilted_files(frames).first()["tilted"] is False
    view = D.canonical_atoms(D.read_atoms(spark, path)).where("frame_idx = 2").first()
    assert (view["px"], view["py"]) == (4.0, 5.0)
    assert D.frame_at(frames, -1).first()["frame_idx"] == 2
    assert D.frame_at(frames, 1).first()["natoms"] == 5
    assert D.frame_at(frames, 9).count() == 0
    assert D.first_frames(frames).first()["timestep"] == 0


def test_windows_line_ends(spark, tmp_path):
    path = write(tmp_path / "crlf", frame_text(3, ["1 1 1 2 3 "], end="\r\n") * 2)
    rows = D.read_atoms(spark, path).collect()
    assert len(rows) == 2 and {r["z"] for r in rows} == {3.0}


def test_frames_survive_file_splits(spark, tmp_path):
    text = "".join(frame_text(i, [f"{k} 1 {i} {k} 0.5" for k in range(1, 6)]) for i in range(300))
    path = write(tmp_path / "big", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        frames = D.with_frame_idx(D.valid_frames(D.read_frames(spark, path)))
        assert frames.select("split_start").distinct().count() > 1
        got = frames.select("frame_idx", "timestep").collect()
        assert sorted((r[0], r[1]) for r in got) == [(i, i) for i in range(300)]
        assert D.read_atoms(spark, path).count() == 1500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_frame_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [f"{i + 1} {1 + i % 2} " + " ".join(repr(float(v)) for v in rng.normal(size=3)) for i in range(20)]
    src = write(tmp_path / "src", frame_text(10, rows) + frame_text(20, rows[:3], box=("0.25 1e-3", "0 10", "0 10")))
    frames = D.valid_frames(D.read_frames(spark, src)).withColumn("out", F.concat(F.lit("f"), "timestep"))
    write_dump(frame_dump_lines(frames, ["out", "timestep"]), str(tmp_path / "out"), "out", ["timestep"])
    back = D.read_atoms(spark, str(tmp_path / "out" / "out=f*"))
    cols = ["timestep", "row_idx", "id", "type", "x", "y", "z", "lx"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, D.read_atoms(spark, src).select(cols).collect()))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "out" / "out=f20")).collect()]
    assert lines[0] == "ITEM: TIMESTEP" and lines[5] == "0.25 0.001 0.0" and lines[9].startswith("1 1 ")


def test_bead_dump(spark, tmp_path):
    beads = spark.createDataFrame(
        [("a", 0, 2, 1, 1.0, 2.0, 3.0, 0.1, 0.2, 0.3), ("a", 0, 1, 2, 4.0, 5.0, 6.0, -0.1, 0.0, 0.0), ("a", 1, 1, 2, 7.0, 8.0, 9.0, 0.0, 0.0, 0.0)],
        "name string, frame_idx long, id long, type int, x double, y double, z double, fx double, fy double, fz double")
    boxes = spark.createDataFrame([("a", 0, 100, [10.0, 0.0, 0.0, 0.0, 11.0, 0.0, 0.0, 0.0, 12.0]), ("a", 1, 50, [10.0, 0.0, 0.0, 0.0, 11.0, 0.0, 0.0, 0.0, 13.0]),
                                   ("a", 2, 60, [1.0] * 9)], "name string, frame_idx long, timestep long, cell array<double>")
    write_dump(bead_dump_lines(beads, boxes, ["name", "frame_idx"]), str(tmp_path / "d"), "name", ["frame_idx"])
    back = D.read_atoms(spark, str(tmp_path / "d" / "name=a")).orderBy("timestep", "row_idx").collect()
    assert [(b["timestep"], b["id"], b["xu"], b["lz"]) for b in back] == [(50, 1, 7.0, 13.0), (100, 1, 4.0, 12.0), (100, 2, 1.0, 12.0)]


@pytest.mark.parametrize("text", ["no frame here\n", ""])
def test_other_files_give_nothing(spark, tmp_path, text):
    path = write(tmp_path / "x", text)
    assert D.valid_frames(D.read_frames(spark, path)).count() == 0
