"""Files are written and read without shuffling their text or sorting it several times."""
import numpy as np
from pyspark.sql import functions as F

from trajlake.plans.audit_queries import _tables
from trajlake.sinks.dumps import write_dump
from trajlake.sinks.training import number_text, write_arrays
from trajlake.sources.lines import read_lines, with_line_no
from trajlake.sources.tables import _by_layout, read_beads_csv


def test_lines_are_numbered_without_a_shuffle_of_text(spark, tmp_path):
    for name, n in (("a", 700), ("b", 3)):
        (tmp_path / name).write_text("".join("\n" if i % 5 == 2 else f"{name} {i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
    try:
        lines = with_line_no(read_lines(spark, str(tmp_path)).where("trim(value) <> ''"))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        got = {(r["file"][-1], r["line_no"]): r["value"] for r in lines.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {(name, at): f"{name} {i}" for name, n in (("a", 700), ("b", 3)) for at, i in enumerate(i for i in range(n) if i % 5 != 2)}
    assert got == want
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_arrays_of_a_set_are_written_together(spark, tmp_path):
    """Several arrays from one sort; a frame in chunks has its energy once."""
    rows = spark.createDataFrame([(s, f, c, [float(100 * f + 10 * c), float(f)], [float(f)] if c == 0 else [])
                                  for s in (0, 1) for f in range(40) for c in (0, 1)], "s int, f long, c int, a array<double>, e array<double>")
    out = write_arrays(rows.repartition(7), str(tmp_path), F.concat(F.lit("set."), "s"), ["f", "c"],
                       {"coord": (F.col("a"), False), "energy": (F.col("e"), True)}, ["f"])
    assert out.count() == 4
    for s in (0, 1):
        want = [[100.0 * f, f, 100 * f + 10, f] for f in range(40)]
        assert np.load(tmp_path / f"set.{s}" / "coord.npy").tolist() == want
        assert np.load(tmp_path / f"set.{s}" / "energy.npy").tolist() == list(range(40))


def test_number_text(spark):
    rows = spark.createDataFrame([([1.5, -0.25],), ([],), (None,), ([float("nan"), None, float("-inf"), 2.0],)], "v array<double>")
    assert [r[0] for r in rows.coalesce(1).select(number_text(F.col("v"), "%.3f")).collect()] == [
        "1.500 -0.250", "", None, "NaN null -Infinity 2.000"]


def test_lines_of_a_dump_are_formed_once(spark, tmp_path):
    """Finding the ranges of the files does not format all lines once more."""
    seen = spark.sparkContext.accumulator(0)

    def text(n):
        seen.add(1)
        return f"line {n}"

    lines = spark.range(500).select(F.lit("a").alias("sim"), (F.col("id") % 50).alias("frame"), F.col("id").alias("line_no"),
                                    F.udf(text, "string")("id").alias("value"))
    write_dump(lines, str(tmp_path / "d"), "sim", ["frame"])
    assert spark.read.text(str(tmp_path / "d")).count() == 500 and seen.value == 500


def test_layouts_are_read_from_the_first_bytes(spark, tmp_path):
    """Header lines of files with odd names, long heads and line ends; no line behind them is looked at."""
    folder = tmp_path / "run 1 %41"
    folder.mkdir()
    long = ",".join(f"column_{i}" for i in range(1000))
    for name, text in (("a b.csv", "id,x\r\n1,2\r\n"), ("b.csv", "id,x\n3,4\n"), ("c.csv", f"{long}\n"), ("d.csv", "")):
        (folder / name).write_bytes(text.encode())
    got = {names: [f.rsplit("/", 1)[1] for f in files] for names, files in _by_layout(spark, str(folder))}
    assert got == {("id", "x"): ["a b.csv", "b.csv"], tuple(long.split(",")): ["c.csv"]}
    back = read_beads_csv(spark, [str(folder / n) for n in ("a b.csv", "b.csv")])
    assert sorted((r["id"], r["x"]) for r in back.collect()) == [(1, 2.0), (3, 4.0)]


def test_audited_beads_are_stored(spark):
    """Every check reads the beads, none builds them again."""
    _, beads = _tables(spark, "/root/testdata/sf0.001")
    plan = beads._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan
