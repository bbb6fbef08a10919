"""Helpers shared by the training-data operators: scratch tables, global ranks, small literal tables."""
from __future__ import annotations

import atexit
import json
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# the bytes a word may not hold, as in ``[^\x20\x09-\x0D]+``
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

_folders: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; one of our own only in a local session without a setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='trajlake-llm-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors; ``release`` removes
    the tables once no result that reads them is needed any more.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{uuid.uuid4().hex}"
    _folders.setdefault(spark.sparkContext.applicationId, []).append(path)
    (df if parts is None else df.coalesce(parts)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: Sequence[DataFrame] = ()) -> None:
    """Delete the scratch tables of this session except those that ``keep`` still reads."""
    sc = spark.sparkContext
    wanted = [f for df in keep for f in df.inputFiles()]
    left = []
    for path in _folders.pop(sc.applicationId, []):
        if any(path.rsplit("/", 1)[1] in f for f in wanted):
            left.append(path)
            continue
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    if left:
        _folders[sc.applicationId] = left


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release(spark)


atexit.register(_release_at_exit)


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small table from driver values, as a JSON literal (no RDD)."""
    names = [field.split()[0] for field in schema.split(",")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{_colons(schema)}>>")))


def _colons(schema: str) -> str:
    return ",".join(":".join(field.split()) for field in schema.split(","))


def bound_batches(df: DataFrame, rows: int = 500) -> DataFrame:
    """Limit the rows of an Arrow batch in the session, as whole texts travel in them; returns ``df``."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(name)) > rows:
        conf.set(name, str(rows))
    return df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def global_rank(df: DataFrame, order: Sequence[Column | str], out: str = "rank") -> DataFrame:
    """Add the 0-based place of each row in the order of the whole table.

    A range sort; a place is the rows of earlier partitions plus the place in
    the own partition.  The sorted rows are stored, so that partition numbers
    stay what they were when they were counted.  Give an order without ties if
    the places must agree between runs.  ``df`` is evaluated twice (the range
    sort samples it): pass a stored table if it is costly.
    """
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    # one row per partition
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (rows.join(F.broadcast(parts), "_part")
            .withColumn(out, (F.col("_row") + F.col("_shift")).cast("bigint")).drop("_row", "_shift", "_part"))


def running_total(df: DataFrame, value: str, order: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before, by the unique dense rank ``order``.

    Blocks of 4,096 ranks are summed inside; only block sums meet in the outer window.
    """
    block = F.floor(F.col(order) / 4096)
    df = df.withColumn("_block", block)
    inside = W.partitionBy("_block").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    top = W.partitionBy("_super").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = (df.groupBy("_block").agg(F.sum(value).alias("_sum"))
            .withColumn("_super", F.floor(F.col("_block") / 4096)))
    tops = sums.groupBy("_super").agg(F.sum("_sum").alias("_top"))
    tops = tops.select("_super", F.coalesce(F.sum("_top").over(
        W.orderBy("_super").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    before = (sums.withColumn("_in", F.coalesce(F.sum("_sum").over(top), F.lit(0))).join(F.broadcast(tops), "_super")
              .select("_block", (F.col("_in") + F.col("_base")).alias("_before")))
    return (df.withColumn("_part_sum", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(before, "_block")
            .withColumn(out, (F.col("_part_sum") + F.col("_before")).cast("bigint"))
            .drop("_block", "_part_sum", "_before"))
