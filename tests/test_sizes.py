"""Faults that showed on larger or odd tables only."""
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from trajlake.operators import graphs, neighbors
from trajlake.operators.ordinals import keyed_position
from trajlake.plans import bindings as at
from trajlake.session import cut_lineage


def test_long_tables_are_not_sent_through_the_driver(spark):
    """Half a million keys with a constant path fill few MB of Parquet, but hundreds in memory."""
    keys = cut_lineage(spark.range(500_000).withColumn("file", F.lit("f" * 100)))
    plan = keys.join(keys.select("file", "id", (F.col("id") + 1).alias("next")), ["file", "id"])._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_file_ends_without_atoms(spark, tmp_path):
    """Orders without line items are frames without atoms, also as first and last frame."""
    con = duckdb.connect()
    con.execute(f"copy (select * from '/root/testdata/sf0.001/orders.parquet' where o_orderkey < 60) to '{tmp_path}/orders.parquet' (format parquet)")
    con.execute(f"copy (select * from '/root/testdata/sf0.001/lineitem.parquet' where l_orderkey between 20 and 40) to '{tmp_path}/lineitem.parquet' (format parquet)")
    for name in ("orders", "lineitem"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    want = con.execute(entry.oracle_sql()["indexed_file_ends"]).fetchall()
    got = entry.queries()["indexed_file_ends"](spark, str(tmp_path)).select("sim", "first", "last").collect()
    assert sorted(tuple(r) for r in got) == sorted(want) and len(want) == 5


def test_positions_of_short_and_long_keys(spark):
    """A window for short keys, a range sort for long ones: the same positions."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 7).alias("k"), F.hash("id").alias("v"), "id")
    want = {tuple(r) for r in rows.withColumn("at", F.expr("row_number() over (partition by k order by v, id) - 1").cast("bigint")).collect()}
    for long in (10_000, 500, 1):
        got = [tuple(r) for r in keyed_position(rows, ["k"], [F.col("v"), F.col("id")], "at", long).collect()]
        assert len(got) == 3000 and set(got) == want


def test_atoms_are_shuffled_once(spark):
    plan = at.atoms(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("box", [(4.0, 4.0, 4.0), (7.0, 10.0, 31.0), (40.0, 3.0, 9.0)])
def test_contacts_meet_once(spark, box):
    """Every pair once, by brute force, also where a box has one or two cells a side; at most 14 cells are visited."""
    rng = random.Random(5)
    points = [(i, *[rng.uniform(-1, 2) * b for b in box]) for i in range(120)]
    atoms = spark.createDataFrame([(0, i, x, y, z, *box) for i, x, y, z in points],
                                  "frame long, row_idx long, px double, py double, pz double, lx double, ly double, lz double")
    def d2(a, b):
        return sum((u - v - round((u - v) / l) * l) ** 2 for u, v, l in zip(a[1:], b[1:], box))
    want = [(a[0], b[0]) for a in points for b in points if a[0] < b[0] and d2(a, b) < 9.0]
    edges = graphs.contact_edges(atoms, ["frame"], 3.0)
    assert sorted((r["src"], r["dst"]) for r in edges.collect()) == sorted(want)
    probes = neighbors.cell_pairs(atoms, atoms.select("frame", "row_idx", "px", "py", "pz", "lx", "ly", "lz").withColumnRenamed("row_idx", "other"),
                                  ["frame"], 3.0, once=True)
    assert probes.where("not same_cell").groupBy(F.least("row_idx", "other"), F.greatest("row_idx", "other")).count().where("count > 1").isEmpty()
