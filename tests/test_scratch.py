"""What lies on disk while files are written and read back."""
import os
import time

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from trajlake.session import cut_lineage, scratch_root, stored, tidy
from trajlake.sinks.training import _join_parts, _npy_head

SF = "/root/testdata/sf0.001"


def files_in(spark):
    root = scratch_root(spark).removeprefix("file://")
    return {os.path.join(at, name) for at, _, names in os.walk(root) for name in names}


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(blocks.apply(i).getName().startswith("shuffle_") for i in range(blocks.size()))


def test_training_files_do_not_stay(spark, tmp_path):
    """Each kind of file is read back and goes before the next is written; the totals are those of the SQL."""
    con = duckdb.connect()
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        con.execute(f"copy (select * from '{SF}/{name}.parquet' where {key} < 40) to '{tmp_path}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    before = files_in(spark)
    out = entry.queries()["training_files"](spark, str(tmp_path))
    left = files_in(spark) - before
    assert left and not [f for f in left if f.endswith((".npy", ".txt"))]
    # the training rows, and the totals of two sorts of array files and five kinds of text
    assert len({os.path.dirname(f) for f in left}) == 8
    want = con.execute(entry.oracle_sql()["training_files"])
    names = [d[0] for d in want.description]
    want = want.fetchall()
    assert sorted(map(tuple, out.select(*names).collect()), key=str) == sorted(want, key=str) and want


def test_tables_stored_on_the_way_are_deleted(spark):
    def make():
        rows = cut_lineage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
        inner.append(len(files_in(spark)))
        return rows.where("k < 3")

    inner, before, tries = [], files_in(spark), 0
    out = stored(spark, make)
    assert inner[0] > len(before) and out.count() == 3
    assert len({os.path.dirname(f) for f in files_in(spark) - before}) == 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    shuffled = shuffle_files(spark)
    with tidy(spark):
        cut_lineage(spark.range(1000).repartition(5, "id"))
        while shuffle_files(spark) > shuffled and (tries := tries + 1) < 100:  # Spark deletes them in the background
            time.sleep(0.1)
        assert shuffle_files(spark) <= shuffled
    with pytest.raises(ZeroDivisionError):
        with tidy(spark):
            cut_lineage(spark.range(5))
            raise ZeroDivisionError
    assert len({os.path.dirname(f) for f in files_in(spark) - before}) == 1


def test_parts_go_when_their_file_is_in_place(tmp_path):
    parts = []
    for i in range(3):
        head = _npy_head((2, 2))
        (tmp_path / f"part{i}").write_bytes(head + np.arange(4.0 * i, 4.0 * i + 4).tobytes())
        parts.append({"part": i, "path": f"part{i}", "head": len(head), "bytes": 32})
    wanted = pd.DataFrame([{"folder": "a", "name": "x", "n_rows": 6, "width": 2, "flat": False, "parts": parts}])
    for _ in range(2):  # once more as a retry, which finds no parts
        assert len(next(_join_parts(f"file://{tmp_path}")(iter([wanted])))) == 1
        assert sorted(os.listdir(tmp_path)) == ["a"]
        assert np.array_equal(np.load(tmp_path / "a" / "x.npy"), np.arange(12.0).reshape(6, 2))
