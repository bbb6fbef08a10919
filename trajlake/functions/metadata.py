"""Simulation, temperature and identity of structures, from file paths and ids."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.text import file_name


def _parts(path: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(path, "^file:/*", "/"), "/"), lambda p: p != "")


def _is_int(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\d+$"), F.lit(False))


def _nth(parts: Column, n: int) -> Column:
    """Element counted from the end (1 = last), NULL when missing."""
    return F.get(parts, F.size(parts) - n)


def dump_labels(path: Column) -> Column:
    """struct(sim_type, temp) of an atom dump.

    A ``traj`` folder comes first, then a numeric parent folder, then a
    ``<prefix>.<temp>.<step>`` name; else the parent folder without temperature.
    """
    parts = _parts(path)
    place = F.array_position(parts, "traj")
    above = F.get(parts, (place - 2).cast("int"))
    parent = _nth(parts, 2)
    tokens = F.split(file_name(path), r"\.")
    second = F.get(tokens, F.size(tokens) - 2)
    none = F.lit(None).cast("int")

    def labels(sim: Column, temp: Column) -> Column:
        return F.struct(sim.alias("sim_type"), temp.try_cast("int").alias("temp"))

    return (F.when((place >= 3) & _is_int(above), labels(F.get(parts, (place - 3).cast("int")), above))
            .when(place >= 2, labels(above, none))
            .when(_is_int(parent), labels(F.coalesce(_nth(parts, 3), F.lit("unknown")), parent))
            .when((F.size(tokens) >= 3) & _is_int(second), labels(parent, second))
            .otherwise(labels(parent, none)))


def bead_dump_labels(path: Column) -> Column:
    """struct(sim_type, temp) of a bead dump: ``<sim>/<temp>/file`` or ``<sim>/file``."""
    parts = _parts(path)
    parent = _nth(parts, 2)
    none = F.lit(None).cast("int")
    return (F.when((F.size(parts) >= 3) & _is_int(parent),
                   F.struct(_nth(parts, 3).alias("sim_type"), parent.try_cast("int").alias("temp")))
            .when(F.size(parts) >= 2, F.struct(parent.alias("sim_type"), none.alias("temp")))
            .otherwise(F.struct(F.lit("unknown").alias("sim_type"), none.alias("temp"))))


def bead_table_labels(path: Column, base_dir: str) -> Column:
    """struct(sim_type, temp) of a bead CSV under ``base_dir``.

    The first folder is the simulation and a numeric second part the
    temperature; a dot token of the name within 100..1000 overrides it.
    """
    base = "^(file:)?/*" + re.escape(base_dir.removeprefix("file:").strip("/")) + "/"
    parts = F.filter(F.split(F.regexp_replace(path, base, ""), "/"), lambda p: p != "")
    stem = F.regexp_replace(file_name(path), r"\.[^.]*$", "")
    tokens = F.filter(F.split(stem, r"\."), lambda t: _is_int(t) & t.try_cast("bigint").between(100, 1000))
    second = F.get(parts, F.lit(1))
    temp = F.coalesce(F.get(tokens, F.lit(0)).try_cast("int"), F.when(_is_int(second), second.try_cast("int")))
    return F.struct(F.get(parts, F.lit(0)).alias("sim_type"), temp.alias("temp"))


def log_folder(path: Column, log_dir: str) -> Column:
    """Folder of the thermo log that belongs to a dump: the folder right under
    ``log_dir``, else the grandparent of the dump."""
    plain = F.regexp_replace(path, "^file:/*", "/")
    root = "/" + log_dir.removeprefix("file:").strip("/")
    below = F.regexp_extract(plain, "^(" + re.escape(root) + "/[^/]+)/", 1)
    direct = F.regexp_extract(plain, "^(" + re.escape(root) + ")/[^/]+$", 1)
    grand = F.regexp_extract(plain, r"^(.*)/[^/]+/[^/]+$", 1)
    return F.when(direct != "", direct).when(below != "", below).otherwise(grand)


def structure_id(sim_type: Column, temp: Column, step: Column) -> Column:
    """``{sim}/{temp or ramp}@{step}``."""
    return F.concat(sim_type, F.lit("/"), F.coalesce(temp.cast("string"), F.lit("ramp")),
                    F.lit("@"), step.cast("string"))


def step_of_id(identity: Column) -> Column:
    return F.when(F.contains(identity, F.lit("@")), F.substring_index(identity, "@", -1).try_cast("bigint"))


def resolved_step(step: Column, identity: Column) -> Column:
    """The step column, else the step written in the structure id."""
    return F.coalesce(step.cast("bigint"), step_of_id(identity))


def fill_metadata(df: DataFrame, temperature_alias: bool = False) -> DataFrame:
    """Default sim_type, step and structure id; optionally 300 K for ramps."""
    df = df.withColumns({"sim_type": F.coalesce("sim_type", F.lit("unknown")),
                         "timestep": F.coalesce("timestep", F.lit(0))})
    built = structure_id(F.col("sim_type"), F.col("temp"), F.col("timestep"))
    known = F.when(F.col("structure_id") != "", F.col("structure_id")) if "structure_id" in df.columns else F.lit(None)
    df = df.withColumn("structure_id", F.coalesce(known, built))
    return df.withColumn("temperature", F.coalesce("temp", F.lit(300))) if temperature_alias else df


def natural_key(path: Column) -> Column:
    """Sort key of a path: the digits of each part that has any, as numbers;
    paths without digits come last, by lower-case name."""
    digits = F.transform(_parts(path), lambda p: F.regexp_replace(p, r"\D", ""))
    numbers = F.transform(F.filter(digits, lambda d: d != ""), lambda d: d.try_cast("decimal(38,0)"))
    bare = F.size(numbers) == 0
    return F.struct(bare.alias("bare"), numbers.alias("numbers"), F.when(bare, F.lower(path)).alias("name"))


def projection_space(columns: Sequence[str]) -> str:
    """pca, umap or tsne, in that order of preference, from column names."""
    for space, prefix in (("pca", "PC"), ("umap", "UMAP"), ("tsne", "tSNE")):
        if any(re.fullmatch(prefix + r"\d+", c) for c in columns):
            return space
    raise ValueError("no PC<n>, UMAP<n> or tSNE<n> columns")


def feature_columns(columns: Sequence[str], space: str) -> list[str]:
    """Feature columns of a space in numeric order (PC2 before PC10)."""
    prefixes = {"pca": "PC", "tsne": "tSNE", "umap": "UMAP"}
    if space not in prefixes:
        raise ValueError(f"unknown space {space!r}")
    found = [c for c in columns if re.fullmatch(prefixes[space] + r"\d+", c)]
    if not found:
        raise ValueError(f"no {space} columns")
    return sorted(found, key=lambda c: int(c[len(prefixes[space]):]))


def clustering_columns(columns: Sequence[str], space: str, pca_dims: int = 3) -> list[str]:
    """Columns to cluster in; a space that is absent falls back to the first components."""
    try:
        found = feature_columns(columns, space)
    except ValueError:
        space, found = "pca", feature_columns(columns, "pca")
    return found[:pca_dims] if space == "pca" else found
