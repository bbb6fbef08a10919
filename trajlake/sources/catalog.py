"""Which files belong to which simulation, and file discovery."""
from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.text import file_name

# fixed values: names that are never atom dumps
NOT_DUMP_SUFFIXES = (".restart", ".data", ".lmp", ".pb", ".pth", ".model", ".sbatch", ".sh", ".slurm", ".py", ".md",
                     ".txt", ".log", ".json", ".yaml", ".toml", ".csv", ".raw", ".npy", ".npz", ".png", ".jpg", ".pdf")
NOT_DUMP_NAMES = ("log.lammps", "in.equil", "in.relax", "in.nve", "README")
BEAD_DUMPS = "*_cg.lammpstrj"


def fill_template(template: str, temp: int | None) -> str:
    """Put the temperature into ``{temp}``, or drop the placeholder with its slash."""
    return re.sub(r"/?\{temp\}", "", template) if temp is None else template.replace("{temp}", str(temp))


def enabled(simulations: Iterable[Mapping], names: Sequence[str] | None = None,
            temps: Sequence[int] | None = None) -> list[dict]:
    """Enabled simulations; ``names`` keeps some, ``temps`` replaces the
    temperatures of those that have any."""
    out = []
    for sim in simulations:
        if not sim.get("enabled", True) or (names is not None and sim["name"] not in names):
            continue
        sim = dict(sim)
        if temps is not None and sim.get("temperatures") is not None:
            sim["temperatures"] = list(temps)
        out.append(sim)
    return out


def globs(simulations: Iterable[Mapping], base_dir: str, folder: str = "trajectory_dir",
          pattern: str | None = None) -> list[tuple[str, int | None, str]]:
    """(simulation, temperature, path glob) for every simulation and temperature."""
    out = []
    for sim in simulations:
        for temp in sim.get("temperatures") or [None]:
            where = fill_template(sim.get(folder) or "", temp).strip("/")
            name = fill_template(pattern or sim["file_pattern"], temp)
            out.append((sim["name"], temp, "/".join(p for p in (base_dir.rstrip("/"), where, name) if p)))
    return out


def _exists(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def list_files(spark: SparkSession, entries: Iterable[tuple[str, int | None, str]]) -> DataFrame:
    """(sim, temp, file, bytes) of all files behind the globs; contents are not read."""
    parts = []
    for sim, temp, pattern in entries:
        if _exists(spark, pattern):
            parts.append(spark.read.format("binaryFile").load(pattern).select(
                F.lit(sim).alias("sim"), F.lit(temp).cast("int").alias("temp"), F.col("path").alias("file"),
                F.col("length").alias("bytes")))
    if not parts:
        return spark.createDataFrame([], "sim string, temp int, file string, bytes bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def may_be_dump(path):
    """Name test for atom dumps; a file without a valid frame drops out on reading."""
    name = file_name(path)
    bad = F.lower(F.lit("")) != ""
    for ending in NOT_DUMP_SUFFIXES:
        bad = bad | F.endswith(name, F.lit(ending))
    return ~(bad | name.isin(*NOT_DUMP_NAMES) | F.contains(name, F.lit(".restart")))


def find_dumps(spark: SparkSession, root: str) -> DataFrame:
    """(file, bytes) of everything under ``root`` whose name may be an atom dump."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes")).where(may_be_dump(F.col("file")))


def find_bead_dumps(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=BEAD_DUMPS).load(root)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def resolve_sources(bead_files: DataFrame, dumps: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """(bead_file, source): the dump a bead CSV was made from, by base name.

    ``folders`` has (sim, temp, priority, folder) of preferred places; among
    equals the first path wins.  Bead files without a source have NULL.
    """
    base = F.regexp_replace(file_name(F.col("file")), r"_particles\.csv$", "")
    beads = bead_files.withColumn("_base", base).withColumnRenamed("file", "bead_file")
    found = beads.join(dumps.select(file_name(F.col("file")).alias("_base"), F.col("file").alias("source")), "_base", "left")
    if folders is not None:
        places = folders.groupBy("sim", "temp").agg(F.array_sort(F.collect_list(F.struct("priority", "folder"))).alias("_p"))
        found = found.join(places, (found["sim"] == places["sim"]) & found["temp"].eqNullSafe(places["temp"]), "left") \
            .drop(places["sim"]).drop(places["temp"])
        parent = F.regexp_replace(F.regexp_extract("source", r"^(.*)/[^/]+$", 1), "^file:/*", "/")
        hits = F.filter("_p", lambda p: F.rtrim(p["folder"], F.lit("/")) == parent)
        rank = F.coalesce(F.get(hits, F.lit(0))["priority"], F.lit(1_000_000))
    else:
        rank = F.lit(0)
    best = F.when(F.col("source").isNotNull(), F.struct(rank, F.col("source")))
    return found.groupBy("bead_file").agg(F.min_by("source", best).alias("source"))
