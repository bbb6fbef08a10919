"""Bead, box and projection tables in CSV form."""
from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.text import bool_cell, int_list

# fixed values: column order of the CSV layouts
BEAD_CSV = ("id bigint, type int, x double, y double, z double, fx double, fy double, fz double, c_pe double, "
            "n_atoms int, atom_indices string, manual_assignment string, assigned_atom_ids string, "
            "match_status string, pattern string, id_pattern string, timestep bigint")
BOX_NAMES = ("xlo", "xhi", "xy", "ylo", "yhi", "xz", "zlo", "zhi", "yz")


def _csv(spark: SparkSession, paths, schema: str, **options) -> DataFrame:
    return (spark.read.options(header=True, enforceSchema=False, quote='"', escape='"', **options)
            .schema(schema).csv(paths))


def _first_lines(batches):
    """(file, head): the first line of each listed file; files without any are left out."""
    for batch in batches:
        out = []
        for path in batch.column("file").to_pylist():
            scheme, _, rest = path.partition(":")
            rest = f"//{rest}" if scheme == "file" and not rest.startswith("//") else rest
            # Spark lists plain names, a URI wants blanks and the like escaped
            files, inner = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/@:=?&[]')}")
            with files.open_input_stream(inner) as stream:
                head = b""
                while b"\n" not in head and (block := stream.read(1 << 12)):
                    head += block
            if head:
                out.append({"file": path, "head": head.split(b"\n")[0].removesuffix(b"\r").decode("utf-8", "replace")})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), ("head", pa.string())]))


def _by_layout(spark: SparkSession, paths) -> list[tuple[tuple[str, ...], list[str]]]:
    """(column names, files) for every distinct header line behind ``paths``.

    Files are listed by Spark and only their first bytes are read; one row per
    layout, with its files, reaches the driver.
    """
    listed = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"))
    heads = listed.mapInArrow(_first_lines, "file string, head string")
    rows = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").collect()
    return [(tuple(next(csv.reader([r["head"]]))), r["files"]) for r in rows]


def _read_layouts(spark: SparkSession, paths, kind_of, **options) -> DataFrame:
    """All files behind ``paths``, each read by its own header; a missing column is NULL."""
    parts = []
    for names, files in _by_layout(spark, paths):
        schema = ", ".join(f"`{n}` {kind_of(n)}" for n in names)
        parts.append(_file_id(_csv(spark, files, schema, **options)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _file_id(df: DataFrame) -> DataFrame:
    return df.withColumn("file", F.col("_metadata.file_path"))


def read_beads_csv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Bead CSVs of any mix of layouts; list and boolean cells become typed columns."""
    known = {p.split()[0]: p.split()[1] for p in BEAD_CSV.split(", ")}
    df = _read_layouts(spark, paths, lambda n: known.get(n, "string"), **options)
    for name, kind in known.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df.withColumns({
        "atom_indices_text": F.col("atom_indices"),
        "atom_indices": int_list(F.col("atom_indices")),
        "assigned_atom_ids": int_list(F.col("assigned_atom_ids")),
        "pattern": int_list(F.col("pattern")).cast("array<int>"),
        "manual_assignment": bool_cell(F.col("manual_assignment")),
    })


def read_boxes_csv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """(file, row_no, cell, timestep); the last column of the file is the step."""
    parts = []
    for names, files in _by_layout(spark, paths):
        df = _csv(spark, files, ", ".join(f"`{n}` double" for n in names), **options)
        parts.append(_file_id(df).select(
            "file", F.monotonically_increasing_id().alias("row_no"),
            F.array(*[F.col(f"`{n}`") for n in names[:-1]]).alias("cell"),
            F.col(f"`{names[-1]}`").cast("bigint").alias("timestep")))
    return reduce(DataFrame.unionByName, parts)


def read_projection_csv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Projection tables: PC/tSNE/UMAP columns are doubles, ids and paths text."""
    kinds = {"timestep": "bigint", "temp": "double", "sim_type": "string", "structure_id": "string",
             "source_file": "string"}
    df = _read_layouts(spark, paths, lambda n: kinds.get(n, "double"), **options).drop("file")
    return df.withColumn("temp", F.col("temp").cast("int")) if "temp" in df.columns else df


def pair_bead_and_box(bead_files: DataFrame, box_files: DataFrame) -> DataFrame:
    """(base, bead_file, box_file): files that differ only in their ending."""
    def base(name: str):
        return F.regexp_replace(name, r"_(particles|box_vectors)\.csv$", "")
    return (bead_files.select(base("file").alias("base"), F.col("file").alias("bead_file"))
            .join(box_files.select(base("file").alias("base"), F.col("file").alias("box_file")), "base"))
