"""Number matrices: ``.raw`` text and ``.npy`` arrays, one row per frame."""
from __future__ import annotations

import ast
from collections.abc import Sequence
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.session import task_count
from trajlake.sources.lines import numbers, read_lines, with_line_no

ROWS_SCHEMA = "file string, frame_no bigint, `values` array<double>"
CHUNK_BYTES = 32 << 20
ROWS = 1 << 16  # matrix rows of an Arrow batch


def read_raw(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """(file, frame_no, values) of space-separated text; blank lines do not count."""
    lines = read_lines(spark, paths, **options).where(F.trim("value") != "")
    return with_line_no(lines, "frame_no").select("file", "frame_no", numbers(F.trim("value")).alias("values"))


def _npy_header(stream) -> tuple[np.dtype, tuple[int, ...], bool, int]:
    magic = stream.read(8)
    if magic[:6] != b"\x93NUMPY":
        raise ValueError("not an npy file")
    size = int.from_bytes(stream.read(2 if magic[6] == 1 else 4), "little")
    head = ast.literal_eval(stream.read(size).decode("latin1"))
    return np.dtype(head["descr"]), head["shape"], head["fortran_order"], stream.tell()


def _read_chunks(batches):
    """Each row names a file and a byte budget slot; read just those matrix rows."""
    for batch in batches:
        for path, slot in zip(batch.column("file").to_pylist(), batch.column("slot").to_pylist()):
            scheme, _, rest = path.partition(":")
            rest = f"//{rest}" if scheme == "file" and not rest.startswith("//") else rest
            # Spark lists plain names, a URI wants blanks and the like escaped
            files, inner = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/@:=?&[]')}")
            with files.open_input_file(inner) as stream:
                kind, shape, fortran, start = _npy_header(stream)
                n = shape[0] if shape else 1
                width = int(np.prod(shape[1:], dtype=np.int64)) if len(shape) > 1 else 1
                if fortran and len(shape) > 1:
                    raise ValueError(f"column-ordered array in {path}")
                per = max(1, CHUNK_BYTES // max(1, width * kind.itemsize))
                a, b = min(n, slot * per), min(n, (slot + 1) * per)
                if a == b:
                    continue
                stream.seek(start + a * width * kind.itemsize)
                block = np.frombuffer(stream.read((b - a) * width * kind.itemsize), dtype=kind).reshape(b - a, width)
            for at in range(0, b - a, ROWS):
                some = block[at:at + ROWS].astype("float64")
                ends = np.arange(len(some) + 1, dtype="int32") * width
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(path), len(some)), pa.array(np.arange(a + at, a + at + len(some), dtype="int64")),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(some.ravel()))], ["file", "frame_no", "values"])


def read_npy(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, frame_no, values) of ``.npy`` files; a 1-d array is one value per frame.

    Only path and length are listed by Spark; the file is then read in chunks
    spread over the tasks, never as one value.
    """
    listed = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "length")
    # a chunk never holds fewer bytes than half the budget unless one row is larger
    slots = listed.select("file", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.ceil(F.col("length") / (CHUNK_BYTES // 2)))).alias("slot"))
    tasks = task_count(listed, F.sum("length"), CHUNK_BYTES)
    return slots.repartition(tasks, "file", "slot").mapInArrow(_read_chunks, ROWS_SCHEMA)


def read_matrix(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``<folder>/<name>.npy`` if there is one, else ``.raw``, else an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for ending, reader in ((".npy", read_npy), (".raw", read_raw)):
        path = f"{folder.rstrip('/')}/{name}{ending}"
        at = hadoop(path)
        if at.getFileSystem(conf).exists(at):
            return reader(spark, path)
    raise FileNotFoundError(f"neither {name}.npy nor {name}.raw in {folder}")
