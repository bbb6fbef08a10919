"""Training-set files: ``.raw`` text, ``.npy`` sets, type files, temperature labels."""
from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.session import cut_lineage, stored, task_count, tidy

PARTS = "folder string, name string, part long, path string, head long, n_rows long, width long, flat boolean, bytes long"
PARTS_SCHEMA = pa.schema([("folder", pa.string()), ("name", pa.string()), ("part", pa.int64()), ("path", pa.string()), ("head", pa.int64()), ("n_rows", pa.int64()),
                          ("width", pa.int64()), ("flat", pa.bool_()), ("bytes", pa.int64())])
COPY_BYTES = 8 << 20
QUANTITIES = ("coord", "force", "atom_ener", "energy", "box")


def number_text(values: Column, pattern: str) -> Column:
    """The numbers of an array by a printf pattern, with blanks between them; a missing number is ``null``.

    Rounded from the exact binary value, as C and NumPy print it.
    """
    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        special = {np.inf: "Infinity", -np.inf: "-Infinity"}

        def cell(v):
            return "null" if v is None else "NaN" if v != v else special.get(v) or pattern % v

        flat = lists.flatten()
        plain = flat.null_count == 0 and bool(np.isfinite(flat.to_numpy(zero_copy_only=False)).all())
        if not plain or lists.null_count:
            return pa.array([None if row is None else " ".join(map(cell, row)) for row in lists.to_pylist()], pa.string())
        values, sizes = flat.to_numpy().tolist(), lists.value_lengths().to_numpy().tolist()
        rows, lines, at = {}, [], 0
        for n in sizes:
            if n not in rows:
                rows[n] = " ".join([pattern] * n)
            lines.append(rows[n] % tuple(values[at:at + n]))
            at += n
        return pa.array(lines, pa.string())

    return run(values.cast("array<double>"))


def write_raw(rows: DataFrame, path: str, by: Sequence[str], order: Sequence[str], values: str,
              pattern: str = "%.8f") -> None:
    """One text line per row, in ``order`` inside each group folder.

    A frame that was packed in several chunks must be one ``values`` array by
    now: the format has one line per frame.
    """
    with tidy(rows.sparkSession):
        (rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
         .select(*by, number_text(F.col(values), pattern).alias("value"))
         .write.mode("overwrite").partitionBy(*by).text(path))


def _open_fs(uri: str):
    return fs.FileSystem.from_uri(uri)


def _qualified(rows: DataFrame, path: str) -> str:
    """``path`` with the scheme Spark's own writers would use for it."""
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file:///") else full


def _npy_head(shape: tuple[int, ...]) -> bytes:
    text = f"{{'descr': '<f8', 'fortran_order': False, 'shape': {shape!r}, }}"
    pad = 64 - (10 + len(text) + 1) % 64
    text = text + " " * (pad % 64) + "\n"
    return b"\x93NUMPY\x01\x00" + len(text).to_bytes(2, "little") + text.encode("latin1")


def _shape(n: int, width: int, flat: bool) -> tuple[int, ...]:
    return (int(n),) if flat else (int(n), int(width))


def _raw_values(lists: pa.ListArray) -> bytes:
    """The numbers of all rows one after the other; a missing row or number is NaN."""
    if lists.null_count:
        lists = pa.array([[np.nan] if v is None else v for v in lists.to_pylist()], pa.list_(pa.float64()))
    return lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype("<f8").tobytes()


def _write_parts(root: str, scratch: str, names: Sequence[str]):
    """Write the rows of each folder in a sorted partition as one part a name, a whole ``.npy`` file if nothing else follows."""
    names = list(names)

    def run(batches):
        files, base = _open_fs(root)
        files.create_dir(f"{base}/{scratch}", recursive=True)
        part = TaskContext.get().partitionId()
        current, n_rows, open_parts, done = None, 0, [], []

        def close():
            for name, path, head, width, flat, sink in open_parts:
                sink.close()
                done.append({"folder": current, "name": name, "part": part, "path": path, "head": len(head), "n_rows": n_rows, "width": width,
                             "flat": flat, "bytes": files.get_file_info(f"{base}/{path}").size - len(head)})

        for batch in batches:
            folders = batch.column("folder").to_pylist()
            cuts = [0, *[i for i in range(1, len(folders)) if folders[i] != folders[i - 1]], len(folders)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if folders[low] != current:
                    close()
                    current, n_rows, open_parts = folders[low], int(batch.column("n_rows")[low].as_py()), []
                    for i, name in enumerate(names):
                        width, flat = int(batch.column(f"width{i}")[low].as_py()), bool(batch.column(f"flat{i}")[low].as_py())
                        path, head = f"{scratch}/{uuid.uuid4().hex}", _npy_head(_shape(n_rows, width, flat))
                        sink = files.open_output_stream(f"{base}/{path}")
                        sink.write(head)
                        open_parts.append((name, path, head, width, flat, sink))
                for i, (*_, sink) in enumerate(open_parts):
                    sink.write(_raw_values(batch.column(f"values{i}").slice(low, high - low)))
        close()
        yield pa.RecordBatch.from_pylist(done, PARTS_SCHEMA)

    return run


def _join_parts(root: str):
    """Put the parts of each file in order behind one head; a file of one part is only moved.

    Parts go as soon as their file is in place, so few bytes exist twice.
    """

    def run(batches):
        files, base = _open_fs(root)
        for pdf in batches:
            done = []
            for folder, name, n, width, flat, parts in zip(*[pdf[c] for c in ("folder", "name", "n_rows", "width", "flat", "parts")]):
                target = f"{base}/{folder}/{name}.npy"
                if sum(int(p["bytes"]) for p in parts) != 8 * int(n) * int(width):
                    raise ValueError(f"parts of {target} do not add up")
                files.create_dir(f"{base}/{folder}", recursive=True)
                own = [f"{base}/{p['path']}" for p in parts]
                there = [info.type == fs.FileType.File for info in files.get_file_info(own)]
                # a retry after the move finds parts gone and the file in place
                if all(there) or files.get_file_info(target).type != fs.FileType.File:
                    whole = own[0]
                    if len(parts) > 1:
                        whole = f"{whole}-{uuid.uuid4().hex}"
                        with files.open_output_stream(whole) as sink:
                            sink.write(_npy_head(_shape(n, width, flat)))
                            for p, path in zip(parts, own):
                                with files.open_input_file(path) as source:
                                    source.seek(int(p["head"]))
                                    while block := source.read(COPY_BYTES):
                                        sink.write(block)
                    files.move(whole, target)
                if len(parts) > 1:
                    for path, found in zip(own, there):
                        if found:
                            files.delete_file(path)
                done.append({"file": f"{folder}/{name}.npy", "rows": int(n), "parts": len(parts)})
            yield pd.DataFrame(done, columns=["file", "rows", "parts"])

    return run


def write_npy(rows: DataFrame, root: str, name: str, folder: Column, order: Sequence[str], values: str,
              frame: Sequence[str], flat: bool = False) -> DataFrame:
    """Write ``<root>/<folder>/<name>.npy``; returns (file, rows, parts).  See ``write_arrays``."""
    return write_arrays(rows, root, folder, order, {name: (F.col(values), flat)}, frame)


def write_arrays(rows: DataFrame, root: str, folder: Column, order: Sequence[str], arrays: Mapping[str, tuple[Column, bool]],
                 frame: Sequence[str]) -> DataFrame:
    """Write ``<root>/<folder>/<name>.npy`` of each name and its (values, flat); returns (file, rows, parts).

    The rows are sorted by range over all tasks, once for all names, so one big
    file is converted by many of them, each writing its stretch as a part;
    neither a set nor a frame (which may come in chunks, some of them without
    values of a name) is held in memory.  Heads are fixed before by counts.
    One task a file then copies its parts' bytes together, as the
    format is one stream, and deletes them; a file of one part is moved.  Parts of lost or failed
    tasks are not listed and go with the scratch folder at the end.  Frames of
    different width in one file are an error; an empty table writes nothing.
    """
    spark, names = rows.sparkSession, list(arrays)
    # from here on values are numbered: the caller's columns may have any name
    named = rows.withColumn("folder", folder).select("folder", *dict.fromkeys([*frame, *order]), *[
        arrays[name][0].alias(f"values{i}") for i, name in enumerate(names)])
    wide = named.groupBy("folder", *frame).agg(*[F.sum(F.size(f"values{i}")).alias(f"width{i}") for i in range(len(names))])
    shape = wide.groupBy("folder").agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.when(F.min(f"width{i}") == F.max(f"width{i}"), F.min(f"width{i}")).otherwise(
            F.raise_error(F.lit("frames of different size in one set")).cast("bigint")).alias(f"width{i}") for i in range(len(names))])
    # one row a folder: without the hint all values would be shuffled to meet it
    ready = named.join(F.broadcast(shape), "folder").repartitionByRange("folder", *order).sortWithinPartitions("folder", *order).select(
        "folder", "n_rows", *[c for i, name in enumerate(names) for c in (
            f"width{i}", F.lit(arrays[name][1]).alias(f"flat{i}"), f"values{i}")])
    base, scratch = _qualified(rows, root), f".{names[0]}-{uuid.uuid4().hex}"

    def files() -> DataFrame:
        parts = cut_lineage(ready.mapInArrow(_write_parts(base, scratch, names), PARTS))
        tasks = task_count(parts, F.sum("bytes"), COPY_BYTES)
        # as many parts a file as there are partitions, at most
        whole = parts.groupBy("folder", "name", "n_rows", "width", "flat").agg(
            F.array_sort(F.collect_list(F.struct("part", "path", "head", "bytes"))).alias("parts"))
        return whole.repartition(tasks, "folder", "name").mapInPandas(_join_parts(base), "file string, rows long, parts long")

    try:
        return stored(spark, files)
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{scratch}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def set_folder(*group: str) -> Column:
    """``<sim>/<temp>/set.NNN`` (the temperature is left out for ramps)."""
    return F.concat_ws("/", *[F.col(g).cast("string") for g in group], F.format_string("set.%03d", F.col("set_id")))


def write_types(types: DataFrame, path: str, by: Sequence[str]) -> None:
    """``type`` and ``type_map`` lines per group, from (group, chunk, codes, type_map)."""
    rows = types.withColumn("type", F.array_join(F.transform("codes", lambda c: c.cast("string")), " "))
    for name in ("type", "type_map"):
        part = rows if name == "type" else rows.where(F.col("chunk") == 0)
        (part.repartitionByRange(*by, "chunk").sortWithinPartitions(*by, "chunk").select(*by, F.col(name).alias("value"))
         .write.mode("overwrite").partitionBy(*by).text(f"{path}/{name}.raw"))


def label_text(value: Column) -> Column:
    """Ten significant digits, as ``%.10g`` prints them."""
    size = F.abs(value)
    digits = F.floor(F.log10(size)).cast("int")
    exponent = F.when(size == 0, F.lit(0)).otherwise(digits)
    # cut to ten significant digits, then drop trailing zeros
    scaled = F.rint(value * F.pow(F.lit(10.0), F.lit(9) - exponent)) / F.pow(F.lit(10.0), F.lit(9) - exponent)
    text = F.format_string("%.14f", scaled)
    return F.when(size == 0, F.lit("0")).when(
        (exponent < -4) | (exponent >= 10),
        F.regexp_replace(F.regexp_replace(F.format_string("%.9e", value), r"(\.\d*?)0+e", "$1e"), r"\.e", "e")).otherwise(
        F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", ""))


def write_labels(rows: DataFrame, path: str, by: Sequence[str], order: Sequence[str], value: str = "fparam") -> None:
    """Temperature labels as ``fparam.raw`` text per group."""
    (rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
     .select(*by, label_text(F.col(value)).alias("value")).write.mode("overwrite").partitionBy(*by).text(path))
