"""How the trajectory operators read the relational test tables.

One order is one frame and its line items are the atoms; events are thermo
log rows; embeddings are structure descriptors.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.operators.ordinals import keyed_position

FRAME = ["frame"]
BOX = (50.0, 12.0, 10.0)
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def atoms(spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    """Line items as atoms; ``labels`` adds sim_type and temp of the frame's order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    lines = keyed_position(lines, ["l_orderkey"], [F.col(c) for c in LINE_ORDER], "row_idx")
    out = lines.select(
        F.col("l_orderkey").alias("frame"), "row_idx", (F.col("row_idx") + 1).alias("id"),
        F.when(F.col("row_idx") % 3 == 0, 1).otherwise(2).alias("type"),
        F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"),
        (F.col("l_tax") * 100).alias("z"),
        F.col("l_discount").alias("fx"), F.col("l_tax").alias("fy"), (F.col("l_quantity") / 50).alias("fz"),
        (F.col("l_extendedprice") / 1000).alias("c_pe"),
        *[F.lit(v).alias(l) for v, l in zip(BOX, ("lx", "ly", "lz"))])
    return out.join(frame_labels(spark, sf_dir), "frame") if labels else out


def frame_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("frame"), F.col("o_orderpriority").alias("sim_type"),
        (F.lit(200) + 100 * (F.col("o_custkey") % 5)).alias("temp"))


def lines_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forces and energies with sim and temperature; no row positions needed."""
    return (table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame"), F.col("l_discount").alias("fx"), F.col("l_tax").alias("fy"),
        (F.col("l_quantity") / 50).alias("fz"), (F.col("l_extendedprice") / 1000).alias("c_pe"))
        .join(frame_labels(spark, sf_dir), "frame"))


def thermo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as thermo rows; a step repeats inside a block."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("sim"), (F.col("user_id") % 3).alias("block_id"),
        (F.col("event_id") % 200).alias("step"), F.col("event_id").alias("line_no"),
        (F.lit(200) + F.col("value")).alias("temp"),
        F.get_json_object("props", "$.k").cast("double").alias("press"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference price against quantity times list price."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return (table(spark, sf_dir, "lineitem")
            .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
            .join(parts, "l_partkey")
            .select(F.col("l_orderkey").alias("frame_no"), (F.col("l_linenumber") % 3).alias("component"),
                    (F.col("l_quantity") * F.col("p_retailprice")).alias("pred"),
                    F.col("l_extendedprice").alias("ref")))


def descriptors(spark: SparkSession, sf_dir: str, dims: int | None = None) -> DataFrame:
    """Embeddings as (structure, label, f1..fD) or, without dims, as an array of doubles.

    A component is the sum of its block of the vector over the root of the
    block's length, so all values count.
    """
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"))
    if dims is None:
        return vectors
    return vectors.select("id", "label", *[
        (F.aggregate(F.slice("features", low + 1, n), F.lit(0.0), lambda a, x: a + x) / math.sqrt(n)).alias(f"f{i + 1}")
        for i, (low, n) in enumerate(_blocks(dims))])


def _blocks(dims: int, width: int = 64) -> list[tuple[int, int]]:
    """(start, length) of ``dims`` blocks that together cover a whole vector."""
    cuts = [i * width // dims for i in range(dims + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


# --- the same bindings for the checking engine -------------------------------

ATOMS_SQL = """atoms AS (
  SELECT *, CASE WHEN row_idx % 3 = 0 THEN 1 ELSE 2 END AS type, row_idx + 1 AS id,
         50::DOUBLE AS lx, 12::DOUBLE AS ly, 10::DOUBLE AS lz
  FROM (SELECT l_orderkey AS frame,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                         l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS row_idx,
      l_quantity AS x, l_discount * 100 AS y, l_tax * 100 AS z,
      l_discount AS fx, l_tax AS fy, l_quantity / 50 AS fz, l_extendedprice / 1000 AS c_pe
    FROM lineitem))"""

LABELS_SQL = """labels_of AS (
  SELECT o_orderkey AS frame, o_orderpriority AS sim_type, 200 + 100 * (o_custkey % 5) AS temp FROM orders)"""

LINES_SQL = LABELS_SQL + """, lines AS (
  SELECT l_orderkey AS frame, l_discount AS fx, l_tax AS fy, l_quantity / 50 AS fz,
         l_extendedprice / 1000 AS c_pe, sim_type, temp
  FROM lineitem JOIN labels_of ON frame = l_orderkey)"""

THERMO_SQL = """thermo AS (
  SELECT event_type AS sim, user_id % 3 AS block_id, event_id % 200 AS step, event_id AS line_no,
         200 + value AS temp, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS press
  FROM events)"""

PAIRS_SQL = """pairs AS (
  SELECT * FROM (
    SELECT c.frame, c.row_idx AS center_row, m.row_idx AS member_row,
      pow((m.x-c.x) - round_even((m.x-c.x)/c.lx,0)*c.lx, 2) + pow((m.y-c.y) - round_even((m.y-c.y)/c.ly,0)*c.ly, 2)
      + pow((m.z-c.z) - round_even((m.z-c.z)/c.lz,0)*c.lz, 2) AS d2
    FROM atoms c JOIN atoms m ON c.frame = m.frame AND c.type = 1 AND m.type = 2)
  WHERE d2 <= 36)"""

PREDICTIONS_SQL = """predictions AS (
  SELECT l_orderkey AS frame_no, l_linenumber % 3 AS component, l_quantity * p_retailprice AS pred,
         l_extendedprice AS ref
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""


def descriptors_sql(dims: int) -> str:
    cols = ", ".join(f"list_sum(embedding[{low + 1}:{low + n}]::DOUBLE[]) / sqrt({n}) AS f{i + 1}" for i, (low, n) in enumerate(_blocks(dims)))
    return f"vectors AS (SELECT vec_id AS id, label::BIGINT AS label, {cols} FROM embeddings)"
