"""Array files written by many tasks."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.sinks.training import write_npy
from trajlake.sources.matrix import read_npy


def chunks(spark, n):
    """Frames of seven values in chunks of four and three; every tenth frame is in a small set."""
    rows = spark.range(n).select(F.col("id").alias("frame_no"), F.when(F.col("id") % 10 == 0, "small set").otherwise("big").alias("name"))
    both = F.array(*[F.struct(F.lit(c).alias("chunk"), F.array(*[(F.col("frame_no") * 10 + i).cast("double") for i in at]).alias("values"))
                     for c, at in ((0, range(4)), (1, range(4, 7)))])
    return rows.select("*", F.explode(both).alias("c")).select("frame_no", "name", "c.*").repartition(5, "values")


def test_a_set_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = write_npy(chunks(spark, 2000), f"{tmp_path}/out", "coord", F.col("name"), ["frame_no", "chunk"], "values", ["frame_no"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    told = {r["file"]: (r["rows"], r["parts"]) for r in out.collect()}
    assert told["big/coord.npy"][0] == 1800 and told["big/coord.npy"][1] > 1 and told["small set/coord.npy"][0] == 200
    for folder, ids in (("big", [i for i in range(2000) if i % 10]), ("small set", range(0, 2000, 10))):
        want = np.array([[i * 10.0 + j for j in range(7)] for i in ids])
        assert np.array_equal(np.load(tmp_path / "out" / folder / "coord.npy"), want)
    assert sorted(os.listdir(tmp_path / "out")) == ["big", "small set"]
    back = read_npy(spark, f"{tmp_path}/out/*/coord.npy")
    assert back.count() == 2000 and back.where("frame_no = 199 AND file LIKE '%small%'").first()["values"][0] == 19900


def test_frames_of_different_width_write_nothing(spark, tmp_path):
    rows = chunks(spark, 20).where("NOT (frame_no = 3 AND chunk = 1)")
    with pytest.raises(Exception, match="different size"):
        write_npy(rows, f"{tmp_path}/out", "coord", F.lit("a"), ["frame_no", "chunk"], "values", ["frame_no"])
    assert not os.path.exists(tmp_path / "out") or os.listdir(tmp_path / "out") == []


def test_empty_tables_and_flat_files(spark, tmp_path):
    rows = chunks(spark, 6).where("chunk = 0").withColumn("values", F.slice("values", 1, 1))
    assert write_npy(rows.limit(0), f"{tmp_path}/none", "e", F.lit("a"), ["frame_no"], "values", ["frame_no"]).count() == 0
    write_npy(rows, f"{tmp_path}/out", "e", F.lit("a"), ["frame_no"], "values", ["frame_no"], True)
    write_npy(rows.where("frame_no < 3"), f"{tmp_path}/out", "e", F.lit("a"), ["frame_no"], "values", ["frame_no"], True)
    assert np.load(tmp_path / "out/a/e.npy").tolist() == [0.0, 10.0, 20.0]  # a second run overwrites


def test_array_files_are_read_by_all_cores(spark, tmp_path):
    """Slots are named by a few rows; adaptive execution must not merge them into one task."""
    write_npy(chunks(spark, 400), f"{tmp_path}/out", "coord", F.col("name"), ["frame_no", "chunk"], "values", ["frame_no"])
    back = read_npy(spark, f"{tmp_path}/out/*/coord.npy")
    assert back.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and back.count() == 400


def test_missing_numbers_become_nan(spark, tmp_path):
    rows = spark.createDataFrame([(0, [1.0, None]), (1, [2.0, 3.0])], "frame_no long, values array<double>")
    write_npy(rows, f"{tmp_path}/out", "x", F.lit("a"), ["frame_no"], "values", ["frame_no"])
    assert np.array_equal(np.load(tmp_path / "out/a/x.npy"), [[1.0, np.nan], [2.0, 3.0]], equal_nan=True)
