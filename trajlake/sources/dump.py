"""Atom dump files as frame and atom tables.

The reader cuts the text at ``ITEM: TIMESTEP``, so one record is one frame and
a file is read in parallel splits without cutting a frame.  Everything after
that is column expressions.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.operators.ordinals import bucketed_position
from trajlake.sources.lines import read_lines

# fixed values: section headers of the dump format
FRAME_MARK = "ITEM: TIMESTEP"
ATOMS_MARK = "ITEM: ATOMS"
COUNT_HEAD = r"ITEM: NUMBER OF ATOMS[^\n]*\n\s*(-?\d+)\s*(?:\n|$)"
BOX_HEAD = r"ITEM: BOX BOUNDS[^\n]*\n([^\n]*)\n([^\n]*)\n([^\n]*)"
ATOM_DOUBLES = ("x", "y", "z", "xu", "yu", "zu", "fx", "fy", "fz", "c_pe")


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def box_columns(header: Column) -> Column:
    """The three axes of a frame's box: lo, hi, tilt."""
    def cell(words: Column, i: int, name: str) -> Column:
        return F.get(words, F.lit(i)).try_cast("double").alias(name)

    # each line is searched and split once
    lines = F.array(*[F.regexp_extract(header, BOX_HEAD, i) for i in (1, 2, 3)])
    return F.transform(F.transform(lines, split_words), lambda w: F.struct(cell(w, 0, "lo"), cell(w, 1, "hi"), cell(w, 2, "tilt")))


def has_box(box: str) -> Column:
    return ~F.exists(box, lambda b: b["lo"].isNull() | b["hi"].isNull())


def read_frames(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """One row per frame record, valid or not.

    ``ok`` is false for a record without step, atom count or box.  ``seq``
    orders frames inside a split; ``body`` holds the atom lines as text.
    """
    records = read_lines(spark, paths, FRAME_MARK, **options)
    text = F.replace(F.col("value"), F.lit("\r"), F.lit(""))
    rows = records.where(F.col("value").rlike(r"\S")).withColumn("_text", text)
    header = F.substring_index("_text", ATOMS_MARK, 1)
    rows = rows.withColumn("_header", header)
    after = F.substring(F.col("_text"), F.length("_header") + 1 + len(ATOMS_MARK), F.length("_text"))
    rows = rows.withColumn("_atoms", F.when(F.length("_header") < F.length("_text"), after))
    rows = rows.select(
        "file", "split_start", "seq",
        F.trim(F.regexp_extract("_header", r"^\n([^\n]*)", 1)).try_cast("bigint").alias("timestep"),
        F.regexp_extract("_header", COUNT_HEAD, 1).try_cast("bigint").alias("natoms"),
        box_columns(F.col("_header")).alias("box"),
        split_words(F.substring_index("_atoms", "\n", 1)).alias("columns"),
        F.when(F.instr("_atoms", "\n") > 0,
               F.expr(r"substr(_atoms, instr(_atoms, '\n') + 1)")).alias("body"))
    return rows.withColumn("ok", F.col("timestep").isNotNull() & F.col("natoms").isNotNull()
                           & has_box("box") & F.col("columns").isNotNull())


def valid_frames(frames: DataFrame) -> DataFrame:
    return frames.where("ok").drop("ok")


def with_frame_idx(frames: DataFrame, out: str = "frame_idx") -> DataFrame:
    """Add the 0-based index of every (valid) frame in its file.

    Only the slim key columns are windowed, per file split.
    """
    key = ["file", "split_start", "seq"]
    index = bucketed_position(frames.select(*key), ["file"], {"_split": F.col("split_start")},
                              [F.col("seq")], out)
    return frames.join(index, key)


def frame_at(frames: DataFrame, index: int) -> DataFrame:
    """The frame at ``index`` of every file; negative counts from the end."""
    if index >= 0:
        return frames.where(F.col("frame_idx") == index)
    sizes = frames.groupBy("file").agg((F.max("frame_idx") + 1 + index).alias("_want"))
    return frames.join(sizes, (frames["file"] == sizes["file"]) & (frames["frame_idx"] == sizes["_want"])) \
        .drop(sizes["file"]).drop("_want")


def first_frames(frames: DataFrame) -> DataFrame:
    """The first frame of each file, found on the keys alone."""
    first = frames.groupBy("file").agg(F.min(F.struct("split_start", "seq")).alias("_first"))
    first = first.select("file", "_first.split_start", "_first.seq")
    return frames.join(first, ["file", "split_start", "seq"], "left_semi")


def is_tilted(box: Column) -> Column:
    """True when a box line carries a non-zero tilt."""
    return F.coalesce(F.exists(box, lambda b: F.abs(b["tilt"]) > 1e-12), F.lit(False))


def tilted_files(frames: DataFrame) -> DataFrame:
    """(file, tilted), judged on the first frame of the file."""
    return first_frames(frames).select("file", is_tilted(F.col("box")).alias("tilted"))


def atom_rows(frames: DataFrame, keep: Sequence[str] = ("file", "seq", "timestep", "natoms"),
              extra: bool = False) -> DataFrame:
    """Explode valid frames into atoms.

    A blank line uses up one of the ``natoms`` slots without giving a row, and
    a short last frame just has fewer rows.  Columns the frame does not name
    are NULL.  ``extra`` adds the remaining columns as a map.
    """
    lines = F.filter(F.slice(F.split("body", "\n"), F.lit(1), F.greatest(F.col("natoms"), F.lit(0)).cast("int")),
                     lambda line: F.trim(line) != "")
    lengths = {l: F.col("box")[i]["hi"] - F.col("box")[i]["lo"] for i, l in enumerate(("lx", "ly", "lz"))}
    places = {f"_at_{c}": F.array_position("columns", c) for c in ("id", "type", *ATOM_DOUBLES)}
    rows = frames.withColumns({**lengths, **places}).select(
        *keep, "columns", *lengths, *places, F.posexplode(lines).alias("row_idx", "_line"))
    rows = rows.withColumn("_v", split_words(F.col("_line")))

    def cell(name: str) -> Column:
        at = F.col(f"_at_{name}")
        return F.when(at > 0, F.get("_v", (at - 1).cast("int")).try_cast("double"))

    out = [*keep, F.col("row_idx").cast("bigint").alias("row_idx"),
           cell("id").try_cast("bigint").alias("id"), cell("type").try_cast("int").alias("type"),
           *[cell(c).alias(c) for c in ATOM_DOUBLES], "lx", "ly", "lz"]
    if extra:
        known = F.array(*[F.lit(c) for c in ("id", "type", *ATOM_DOUBLES)])
        pairs = F.filter(F.arrays_zip(F.col("columns").alias("c"), F.col("_v").alias("v")),
                         lambda p: ~F.array_contains(known, p["c"]) & p["v"].isNotNull() & p["c"].isNotNull())
        out.append(F.map_from_entries(F.transform(pairs, lambda p: F.struct(
            p["c"], p["v"].try_cast("double")))).alias("extra"))
    return rows.select(*out)


def canonical_atoms(atoms: DataFrame) -> DataFrame:
    """Analysis view: one position (unwrapped, else wrapped, else zero), energy, force."""
    def pick(u: str, w: str) -> Column:
        unwrapped = F.col("xu").isNotNull() & F.col("yu").isNotNull() & F.col("zu").isNotNull()
        wrapped = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
        return F.when(unwrapped, F.col(u)).when(wrapped, F.col(w)).otherwise(F.lit(0.0))
    return atoms.withColumns({p: pick(u, w) for p, u, w in
                              (("px", "xu", "x"), ("py", "yu", "y"), ("pz", "zu", "z"))})


def read_atoms(spark: SparkSession, paths: str | Sequence[str], extra: bool = False, **options) -> DataFrame:
    """Atoms of all valid frames with file, frame_idx, timestep."""
    frames = with_frame_idx(valid_frames(read_frames(spark, paths, **options)))
    return atom_rows(frames, ("file", "frame_idx", "timestep", "natoms"), extra)
