"""The frame index: same frames and atoms as the line reader at any range size, pruned reads, odd files."""
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, IsNotNull

from trajlake.plans.analysis import attach_frames, write_picks
from trajlake.sources import dump as D
from trajlake.sources import frame_index as X

from test_dumps import frame_text, write

ODD = ("title line\n\n" + frame_text(0, ["1 1 1.5 2 3", "", "2 2 4 5 6", "3 2 9 9 9"], natoms=3)
       + "ITEM: TIMESTEP\n5\nITEM: NUMBER OF ATOMS\n1\nITEM: ATOMS id type x y z\n1 1 0 0 0\n"
       + frame_text(7, ["1 1 0 0 bad", "2 2 1 1", "3 x nan 1e3 -2"], natoms=5, box=("0 10 0.5", "-1 9 0", "0 10 0"))
       + frame_text(7, ["2 2 1 2 3 4 5 6 -0.25 7"], "id type x y z xu yu zu c_pe q") + frame_text(8, [], natoms=0)
       + frame_text(9, [f"{i} 1 {i}.25 0 -{i}" for i in range(40)], natoms=39) + "ITEM: TIMESTEP\n10\nITEM: NUMBER OF ATOMS\n3\n")
COLUMNS = ["frame_idx", "timestep", "natoms", "row_idx", "id", "type", *D.ATOM_DOUBLES, "lx", "ly", "lz"]


def seen(df, columns):
    return sorted((repr(tuple(r)) for r in df.select(*columns).collect()))


@pytest.mark.parametrize("split", [40, 97, 333, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_as_line_reader(spark, tmp_path, split, end):
    write(tmp_path / "a", ODD.replace("\n", end))
    write(tmp_path / "b", "".join(frame_text(i, [f"{k} 1 {i} {k} 0.5" for k in range(1, 30)]) for i in range(5)).replace("\n", end))
    write(tmp_path / "c", "no frame here\n")
    write(tmp_path / "d", "")
    write(tmp_path / "e", frame_text(3, ["1 1 1 2 3"]).rstrip("\n"))
    index = X.frame_index(X.list_files(spark, str(tmp_path / "*")), split)
    records = D.read_frames(spark, str(tmp_path / "*"))
    frames = D.with_frame_idx(D.valid_frames(records))
    of = ["file", "frame_idx", "timestep", "natoms", "box", "columns"]
    assert seen(index.frames.where("ok"), of) == seen(frames, of)
    bad = lambda df: {r["file"]: r["n"] for r in df.groupBy("file").agg(F.count_if(~F.col("ok")).alias("n")).collect()}
    assert bad(index.frames) == bad(records)
    want = D.atom_rows(frames, ("file", "frame_idx", "timestep", "natoms"))
    assert seen(X.indexed_atoms(index.parts), ["file", *COLUMNS]) == seen(want, ["file", *COLUMNS])
    if split < 100:
        assert index.parts.groupBy("file", "offset").count().agg(F.max("count")).first()[0] > 3  # frames over many ranges


def test_filters_choose_the_bytes(spark, tmp_path):
    path = write(tmp_path / "big", "".join(frame_text(i * 10, [f"{k} 1 {i} {k} 0.5" for k in range(1, 6)]) for i in range(300)))
    index = X.frame_index(X.list_files(spark, path), 1000)
    atoms = X.read_index_atoms(index)
    some = atoms.where("timestep >= 100 and timestep < 130 and x > 10")
    assert sorted((r["timestep"], r["row_idx"], r["x"]) for r in some.collect()) == [(110 + 10 * i, k, 11.0 + i) for i in range(2) for k in range(5)]
    assert atoms.where(F.col("frame_idx").isin(5, 299)).count() == 10 and atoms.where("timestep = 7").count() == 0 and atoms.count() == 1500
    reader = X.AtomsReader("unused")
    assert list(reader.pushFilters([EqualTo(("timestep",), 10), EqualTo(("x",), 1.0), IsNotNull(("timestep",))])) == [
        EqualTo(("x",), 1.0), IsNotNull(("timestep",))] and reader.wanted == [("timestep", "=", 10)]
    read = index.parts.where("timestep = 110").agg(F.sum(F.expr("stop - start"))).first()[0]
    assert 0 < read < os.path.getsize(path) / 50


def test_reader_opens_only_wanted_ranges(spark, tmp_path, monkeypatch):
    """With the filters pushed the reader touches the parts that pass, no others."""
    path = write(tmp_path / "f", "".join(frame_text(i, [f"{k} 1 0 0 0" for k in range(1, 40)]) for i in range(20)))
    index = X.frame_index(X.list_files(spark, path), 300)
    index.parts.coalesce(1).write.parquet(str(tmp_path / "index"))
    opened = []
    monkeypatch.setattr(X, "part_atoms", lambda **part: opened.append(part["timestep"]) or iter([]))
    reader = X.AtomsReader(f"file://{tmp_path}/index")
    reader.wanted = [("timestep", "=", 4)]
    for p in reader.partitions():
        list(reader.read(p))
    assert opened and set(opened) == {4}


def test_picks_read_their_frames_only(spark, tmp_path):
    a = write(tmp_path / "in" / "a", frame_text(5, ["1 1 1 1 1"]) + frame_text(5, ["1 1 2 2.50 2 9"], "id type x y z q") + frame_text(6, ["7 1 3 3 3"]))
    picks = spark.createDataFrame([("s/1@5", a, 5), ("s/1@6", a, None), ("s/1@9", a, 9), ("t/1@5", a + "-gone", 5), ("u", None, 1)],
                                  "structure_id string, source_file string, timestep bigint")
    manifest, lines = attach_frames(picks)
    assert {r["structure_id"]: r["status"] for r in manifest.collect()} == {
        "s/1@5": "written", "s/1@6": "written", "s/1@9": "no such frame", "t/1@5": "source missing", "u": "source missing"}
    write_picks(lines, str(tmp_path / "out"))
    back = D.read_atoms(spark, str(tmp_path / "out" / "*"), extra=True).collect()
    assert sorted((r["timestep"], r["id"], r["y"], dict(r["extra"])["q"] if r["extra"] else None) for r in back) == [(5, 1, 2.5, 9.0), (6, 7, 3.0, None)]
    assert manifest.where("status = 'written' and output_file = ''").isEmpty()


def test_no_files(spark):
    index = X.frame_index(spark.createDataFrame([], "file string, size bigint"))
    assert index.frames.count() == 0 and X.indexed_atoms(index.parts).count() == 0


def test_many_small_frames_are_read_together(spark, tmp_path, monkeypatch):
    """Frames that follow each other cost one open file, not one each; odd ones are parsed as before."""
    path = write(tmp_path / "many", "".join(frame_text(i, [f"{k} 1 {i}.5 {k} 0.5" for k in range(1, 5)]) for i in range(300)))
    index = X.frame_index(X.list_files(spark, path), 1000)
    index.parts.coalesce(1).sortWithinPartitions("start").write.parquet(str(tmp_path / "index"))
    opened, real = [], X.fs

    def from_uri(uri):
        opened.append(uri)
        return real.FileSystem.from_uri(uri)

    monkeypatch.setattr(X, "fs", SimpleNamespace(FileSystem=SimpleNamespace(from_uri=from_uri), FileSelector=real.FileSelector))
    reader = X.AtomsReader(f"file://{tmp_path}/index")
    rows = [r for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
    assert sum(uri.endswith("many") for uri in opened) == 1
    assert sorted((r["timestep"], r["row_idx"], r["x"], r["y"]) for r in rows) == [(i, k, i + 0.5, k + 1.0) for i in range(300) for k in range(4)]


def test_a_scan_uses_all_cores(spark, tmp_path, monkeypatch):
    """The rows that name ranges are few bytes; adaptive execution must not merge them into one task."""
    for i in range(40):
        write(tmp_path / "in" / f"f{i}", frame_text(i, ["1 1 1 2 3"]))
    tasks, real = [], X.cut_lineage
    monkeypatch.setattr(X, "cut_lineage", lambda df: tasks.append(df.rdd.getNumPartitions()) or real(df))
    X.frame_index(X.list_files(spark, str(tmp_path / "in" / "*")))
    assert tasks[0] >= spark.sparkContext.defaultParallelism
