"""Scratch tables shared by the iterative operators."""
from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# bytes of a stored row in memory for one in the file, at least: sorted keys and repeated paths take next to nothing in
# Parquet, and Spark judges by the file what it may send whole through the driver
COMPRESSION = "spark.sql.sources.fileCompressionFactor"
FACTOR = 10.0
# Spark else keeps the shuffle files of a finished write until the driver happens to collect its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_folders: dict[str, list[str]] = {}
_block: ContextVar[list[str] | None] = ContextVar("_block", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``).

    Only a local session without the setting gets a folder of its own; on a
    cluster the setting is required, as executors don't share local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='trajlake-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_folder(df: DataFrame) -> str:
    """A fresh folder name in the shared folder, for files other tasks must see."""
    return _fresh(df.sparkSession, "files")


def _fresh(spark: SparkSession, kind: str) -> str:
    path = f"{scratch_root(spark)}/{kind}-{uuid.uuid4().hex}"
    own = _block.get()
    (_folders.setdefault(spark.sparkContext.applicationId, []) if own is None else own).append(path)
    return path


def guard_broadcasts(spark: SparkSession) -> None:
    """Let Spark expect Parquet tables to be ten times their files, unless the session expects more.

    Otherwise a table of a million keys passes as small and is sent to all
    executors through the driver, where it takes hundreds of MB.
    """
    if float(spark.conf.get(COMPRESSION)) < FACTOR:
        spark.conf.set(COMPRESSION, str(FACTOR))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and read it back.

    Later steps read only the columns and rows they need, and a lost executor
    costs a re-read.  Columns without a type are put back as NULL.
    """
    return _store(df, _fresh(df.sparkSession, "rows"))


def stored(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``make`` returns, stored as by ``cut_lineage``; all that ``make`` itself stored is deleted."""
    path = _fresh(spark, "rows")
    with tidy(spark):
        return _store(make(), path)


def _store(df: DataFrame, path: str) -> DataFrame:
    void = [c for c, kind in df.dtypes if kind == "void"]
    guard_broadcasts(df.sparkSession)
    kept = df.drop(*void)
    kept.write.parquet(path)
    out = df.sparkSession.read.schema(kept.schema).parquet(path)
    return out.select(*[F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns]) if void else out


def task_count(rows: DataFrame, n_bytes: Column, split: int) -> int:
    """Tasks for work on that many bytes: one per ``split`` of them, and at least one a core.

    The rows that name the work are small, so their own size (by which adaptive
    execution merges partitions) says nothing about it.
    """
    total = rows.agg(n_bytes.alias("n")).first()["n"] or 0
    return max(math.ceil(total / split), rows.sparkSession.sparkContext.defaultParallelism)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is deleted at the end, and shuffle files after each write.

    Nothing that reads the tables of the block may be used after it.
    """
    own: list[str] = []
    token, before = _block.set(own), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        _block.reset(token)
        spark.conf.set(CLEANUP, before)
        _delete(spark, own)


def release(spark: SparkSession) -> None:
    """Delete the scratch tables of this session; call it when no result reads them any more."""
    _delete(spark, _folders.pop(spark.sparkContext.applicationId, []))


def _delete(spark: SparkSession, paths: Sequence[str]) -> None:
    sc = spark.sparkContext
    for path in paths:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release(spark)


atexit.register(_release_at_exit)
