"""A stored index of the frames in dump files, and reads of only the bytes that are asked for.

One scan over byte ranges of the files notes where frames and their atom lines
lie.  A frame may span any number of ranges; no text is shuffled and no frame
is one value.  Atoms are read from the index: as rows of a DataFrame, or as a
data source whose filters on step and frame decide which bytes are read.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
                                    LessThanOrEqual)

from trajlake.operators.ordinals import bucketed_position
from trajlake.session import cut_lineage, shared_folder, task_count
from trajlake.sources.dump import ATOM_DOUBLES, ATOMS_MARK, COUNT_HEAD, FRAME_MARK, box_columns, has_box, split_words

SPLIT = 32 << 20  # bytes of a range
AHEAD = 1 << 16
HEADER = 1 << 20  # bytes in which a header must end
ROWS = 1 << 16  # atoms of an Arrow batch
STRETCH = 4 << 20  # bytes that are read and parsed together
FEW = 8  # parts of a stretch that are read one by one
FRAME = ["file", "frame_idx"]

_PORTION = ("file string, split_start bigint, start bigint, stop bigint, mark boolean, header string, columns string, body_start bigint, "
            "n_lines bigint, n_filled bigint, atoms_at bigint, n_lines_after bigint, n_filled_after bigint")
ATOM_SCHEMA = ("file string, frame_idx bigint, timestep bigint, natoms bigint, row_idx bigint, id bigint, type int, "
               + ", ".join(f"{c} double" for c in (*ATOM_DOUBLES, "lx", "ly", "lz")))


# --- files -------------------------------------------------------------------

def list_files(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """(file, size) of the files behind ``paths``; no content is read."""
    return (spark.read.format("binaryFile").options(**options).load(paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")))


def stat_files(files: DataFrame) -> DataFrame:
    """(file, size) of the named files that exist, looked up in tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(name)
                info = system.get_file_info(path)
                if info.type == fs.FileType.File:
                    out.append((name, info.size))
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], ["file", "size"])

    return files.select("file").where("file is not null").distinct().mapInArrow(run, "file string, size bigint")


# --- scan --------------------------------------------------------------------

def _aligned(src, at: int, size: int) -> int:
    """The start of the first line that begins at ``at`` or later."""
    if at <= 0 or at >= size:
        return min(max(at, 0), size)
    at -= 1
    while at < size:
        some = src.read_at(min(AHEAD, size - at), at)
        found = some.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(some)
    return size


def _count(text: bytes) -> tuple[int, int]:
    """Lines, and lines that aren't blank."""
    lines = text.split(b"\n")
    if not lines[-1]:
        lines.pop()
    return len(lines), sum(1 for line in lines if line.strip(b" \r"))


def _head(src, data: bytes, start: int, at: int, end: int, size: int) -> tuple[str, str | None, int | None]:
    """(header, column names, where the atom lines start) of the frame whose mark ends at ``at``.

    The header may go on behind the range, up to the next mark.
    """
    text, mark, atoms = data[at - start:end - start], FRAME_MARK.encode(), ATOMS_MARK.encode()
    more = end
    while end == start + len(data) and more < size and len(text) < HEADER:
        cut = text.find(atoms)
        if cut >= 0 and text.find(b"\n", cut) >= 0:
            break
        some = src.read_at(min(AHEAD, size - more), more)
        text, more = text + some, more + len(some)
    text = text.split(mark, 1)[0]
    cut = text.find(atoms)
    if cut < 0:
        return text[:HEADER].decode("utf-8", "replace"), None, None
    stop = text.find(b"\n", cut)
    names = text[cut + len(atoms):len(text) if stop < 0 else stop]
    return text[:cut].decode("utf-8", "replace"), names.decode("utf-8", "replace"), None if stop < 0 else at + stop + 1


def _portions(file: str, size: int, begin: int, end: int) -> list[tuple]:
    """What lies in the lines that begin in a range: the rest of a frame begun earlier, then frames."""
    system, path = fs.FileSystem.from_uri(file)
    with system.open_input_file(path) as src:
        start, stop = _aligned(src, begin, size), _aligned(src, end, size)
        data, mark, atoms = src.read_at(stop - start, start), FRAME_MARK.encode(), ATOMS_MARK.encode()
        marks, at = [], data.find(mark)
        while at >= 0:
            marks.append(at)
            at = data.find(mark, at + len(mark))
        out, first = [], marks[0] if marks else len(data)
        if first:
            lead, cut = data[:first], data.find(atoms, 0, first)
            after = None if cut < 0 else (lead.find(b"\n", cut) + 1 or first)
            out.append((file, begin, start, start + first, False, None, None, None, *_count(lead), None if after is None else start + after,
                        *((None, None) if after is None else _count(lead[after:]))))
        for here, there in zip(marks, [*marks[1:], len(data)]):
            header, names, body = _head(src, data, start, start + here + len(mark), start + there, size)
            lines = (0, 0) if body is None or body >= start + there else _count(data[body - start:there])
            out.append((file, begin, start + here, start + there, True, header.replace("\r", ""), names and names.replace("\r", ""), body, *lines,
                        None, None, None))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(f.split()[0], {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}[f.split()[1]])
                        for f in _PORTION.split(", ")])
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            found = _portions(*row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


@dataclass
class FrameIndex:
    """``frames``: one row per record, valid or not; ``parts``: where the atom lines of the valid frames are."""

    frames: DataFrame  # file, offset, frame_idx, timestep, natoms, box, columns, ok
    parts: DataFrame   # file, offset, frame_idx, timestep, natoms, columns, lx, ly, lz, start, stop, slot, row

    def of(self, frames: DataFrame) -> DataFrame:
        """The parts of the given frames (file, frame_idx)."""
        return self.parts.join(frames.select(*FRAME).distinct(), FRAME, "left_semi")


def frame_index(files: DataFrame, split_bytes: int = SPLIT) -> FrameIndex:
    """The stored index of the files (file, size), built in one scan of their bytes.

    Text before the first frame of a file counts as one invalid record, as
    does a frame without step, atom count, box or atom section.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint")))
    splits = files.where("size > 0").select("file", "size", starts.alias("begin"))
    splits = splits.select("file", "size", "begin", (F.col("begin") + split_bytes).alias("end"))
    tasks = task_count(files, F.sum("size"), SPLIT)
    seen = cut_lineage(splits.repartition(tasks, "file", "begin").mapInArrow(_scan, _PORTION))

    heads = seen.where("mark").select(
        "file", F.col("start").alias("offset"), "split_start", "body_start",
        F.trim(F.regexp_extract("header", r"^\n([^\n]*)", 1)).try_cast("bigint").alias("timestep"),
        F.regexp_extract("header", COUNT_HEAD, 1).try_cast("bigint").alias("natoms"),
        box_columns(F.col("header")).alias("box"), split_words(F.col("columns")).alias("columns"))
    heads = heads.withColumn("ok", F.col("timestep").isNotNull() & F.col("natoms").isNotNull() & has_box("box") & F.col("columns").isNotNull())
    numbered = bucketed_position(heads.where("ok").select("file", "split_start", "offset"), ["file"], {"_split": F.col("split_start")},
                                 [F.col("offset")], "frame_idx").select("file", "offset", "frame_idx")
    frames = cut_lineage(heads.join(numbered, ["file", "offset"], "left"))

    # the frame that a range begins in: one row per range meets in the window
    before = W.partitionBy("file").orderBy("split_start").rowsBetween(W.unboundedPreceding, -1)
    owners = (seen.groupBy("file", "split_start").agg(F.max(F.when(F.col("mark"), F.col("start"))).alias("_last"))
              .select("file", "split_start", F.last("_last", ignorenulls=True).over(before).alias("_owner")))
    placed = seen.join(owners, ["file", "split_start"]).withColumn("offset", F.when(F.col("mark"), F.col("start")).otherwise(F.col("_owner")))
    foreign = placed.where("offset is null and n_filled > 0").select("file").distinct().select(
        "file", F.lit(0).cast("bigint").alias("offset"), F.lit(False).alias("ok"))

    valid = frames.where("ok and body_start is not null").select("file", "offset", "frame_idx", "timestep", "natoms", "box", F.col("columns").alias("names"),
                                                                 F.col("body_start").alias("body"))
    late = F.col("body") > F.col("start")  # the header ends in this portion
    counts = {"lines": (F.when(F.col("mark"), F.col("n_lines")).when(late, F.col("n_lines_after")).otherwise(F.col("n_lines"))),
              "filled": (F.when(F.col("mark"), F.col("n_filled")).when(late, F.col("n_filled_after")).otherwise(F.col("n_filled")))}
    earlier = W.partitionBy("file", "offset").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    parts = (placed.where("offset is not null").join(valid, ["file", "offset"]).where("body < stop").withColumns(counts)
             .withColumns({"slot": F.coalesce(F.sum("lines").over(earlier), F.lit(0)), "row": F.coalesce(F.sum("filled").over(earlier), F.lit(0))})
             .where("slot < natoms").select(
                 "file", "offset", "frame_idx", "timestep", "natoms", F.col("names").alias("columns"),
                 *[(F.col("box")[i]["hi"] - F.col("box")[i]["lo"]).alias(n) for i, n in enumerate(("lx", "ly", "lz"))],
                 F.greatest("start", "body").alias("start"), "stop", "slot", "row"))
    frames = frames.drop("split_start", "body_start").unionByName(foreign, allowMissingColumns=True)
    return FrameIndex(cut_lineage(frames), cut_lineage(parts))


# --- atoms -------------------------------------------------------------------

def _cell(text: bytes) -> float | None:
    try:
        return None if b"_" in text else float(text)
    except ValueError:
        return None


def parse_rows(data: bytes, slots: int, width: int, wanted: Sequence[int]) -> tuple[int, list[pa.Array]]:
    """(rows, columns ``wanted``) of the lines among the first ``slots`` ones that aren't blank.

    Numbers are read at once where each line has ``width`` of them, or else
    cell by cell; what is missing or no number is null.
    """
    data = data.replace(b"\r", b"")
    text = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(text == 10)
    if len(ends) >= slots:
        data = data[:ends[slots - 1] + 1] if slots else b""
        text, ends = text[:len(data)], ends[:slots]
    token = text > 32
    begins = np.flatnonzero(token & ~np.concatenate([[False], token[:-1]])) if len(text) else np.zeros(0, np.int64)
    per_line = np.bincount(np.searchsorted(ends, begins), minlength=1) if len(begins) else np.zeros(0, np.int64)
    per_line = per_line[per_line > 0]
    if width and (per_line == width).all():
        try:
            values = np.array(data.split(), dtype=np.float64).reshape(-1, width)
            return len(values), [pa.array(values[:, i]) for i in wanted]
        except ValueError:
            pass
    lines = [line.split() for line in data.split(b"\n") if line.strip(b" ")]
    return len(lines), [pa.array([_cell(line[i]) if i < len(line) else None for line in lines], pa.float64()) for i in wanted]


def _whole(values: pa.Array, kind: pa.DataType) -> pa.Array:
    """Doubles as integers, cut off; what doesn't fit is null."""
    x = values.to_numpy(zero_copy_only=False)
    most = 2.0 ** (31 if kind == pa.int32() else 63)
    fits = (x > -most - 1) & (x < most)
    return pa.array(np.where(fits, x, 0).astype(np.int64), kind, mask=~fits)


def part_atoms(file, frame_idx, timestep, natoms, columns, lx, ly, lz, start, stop, slot, row, **_) -> Iterator[pa.RecordBatch]:
    """The atoms of one part."""
    system, path = fs.FileSystem.from_uri(file)
    with system.open_input_file(path) as src:
        data = src.read_at(stop - start, start)
    names = ["id", "type", *ATOM_DOUBLES]
    have = [n for n in names if n in columns]
    n, found = parse_rows(data, natoms - slot, len(columns), [columns.index(c) for c in have])
    cells = dict(zip(have, found))
    none = pa.nulls(n, pa.float64())
    same = [pa.array([v] * n, t) for v, t in ((file, pa.string()), (frame_idx, pa.int64()), (timestep, pa.int64()), (natoms, pa.int64()))]
    box = [pa.array([v] * n, pa.float64()) for v in (lx, ly, lz)]
    whole = pa.RecordBatch.from_arrays(
        [*same, pa.array(np.arange(row, row + n)), _whole(cells.get("id", none), pa.int64()), _whole(cells.get("type", none), pa.int32()),
         *[cells.get(c, none) for c in ATOM_DOUBLES], *box], [f.split()[0] for f in ATOM_SCHEMA.split(", ")])
    for at in range(0, n, ROWS):
        yield whole.slice(at, ROWS)


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    columns = [batch.column(name).to_pylist() for name in batch.schema.names]
    for values in zip(*columns):
        yield dict(zip(batch.schema.names, values))


def _stretches(parts: Iterator[dict]) -> Iterator[list[dict]]:
    """Runs of parts of one file and layout that follow each other closely."""
    run: list[dict] = []
    for part in parts:
        if run and (part["file"] != run[0]["file"] or part["columns"] != run[0]["columns"] or not run[-1]["stop"] <= part["start"] <= run[-1]["stop"] + AHEAD
                    or part["stop"] - run[0]["start"] > STRETCH):
            yield run
            run = []
        run.append(part)
    if run:
        yield run


def _atoms(parts: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """The atoms of parts; those of a stretch of many parts are read and parsed together."""
    for run in _stretches(parts):
        whole = stretch_atoms(run) if len(run) > FEW else None
        if whole is None:
            for part in run:
                yield from part_atoms(**part)
        else:
            for at in range(0, whole.num_rows, ROWS):
                yield whole.slice(at, ROWS)


def stretch_atoms(run: list[dict]) -> pa.RecordBatch | None:
    """The atoms of adjacent parts as one batch; None where a line is blank, too short, too long, no numbers or behind the last slot."""
    columns, first = run[0]["columns"], run[0]["start"]
    system, path = fs.FileSystem.from_uri(run[0]["file"])
    with system.open_input_file(path) as src:
        text = src.read_at(run[-1]["stop"] - first, first)
    bodies = [text[p["start"] - first:p["stop"] - first] for p in run]
    counts = np.array([b.count(b"\n") + (not b.endswith(b"\n")) for b in bodies])
    if b"\r" in text or (counts > np.array([p["natoms"] - p["slot"] for p in run])).any():
        return None
    n, width = int(counts.sum()), len(columns)
    names = ["id", "type", *ATOM_DOUBLES]
    wanted = [(c, columns.index(c)) for c in names if c in columns]
    lines = b"".join(b if b.endswith(b"\n") else b + b"\n" for b in bodies)
    data = np.frombuffer(lines, np.uint8)
    token = data > 32
    begins = np.flatnonzero(token[1:] & ~token[:-1]) + 1
    if token[0]:
        begins = np.concatenate([[0], begins])
    per_line = np.bincount(np.searchsorted(np.flatnonzero(data == 10), begins), minlength=n)
    if len(per_line) != n or not (per_line == width).all():
        return None
    try:
        values = np.array(lines.split(), dtype=np.float64).reshape(n, width)
    except ValueError:
        return None
    cells = {c: pa.array(values[:, i]) for c, i in wanted}
    owner = pa.array(np.repeat(np.arange(len(run)), counts))
    said = {f: pa.array([p[f] for p in run], pa.int64()).take(owner) for f in ("frame_idx", "timestep", "natoms")}
    box = [pa.array([p[f] for p in run], pa.float64()).take(owner) for f in ("lx", "ly", "lz")]
    rows = np.arange(n) + np.repeat(np.array([p["row"] for p in run]) - (np.cumsum(counts) - counts), counts)
    none = pa.nulls(n, pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(run[0]["file"], pa.string()), n), *said.values(), pa.array(rows), _whole(cells.get("id", none), pa.int64()),
         _whole(cells.get("type", none), pa.int32()), *[cells.get(c, none) for c in ATOM_DOUBLES], *box], [f.split()[0] for f in ATOM_SCHEMA.split(", ")])


def _spread(parts: DataFrame) -> DataFrame:
    """Parts dealt out so that a task reads about one range of bytes, neighbours one after the other."""
    tasks = task_count(parts, F.sum(F.col("stop") - F.col("start")), SPLIT)
    return parts.repartition(tasks, F.col("file"), F.floor(F.col("start") / STRETCH)).sortWithinPartitions("file", "start")


def indexed_atoms(parts: DataFrame) -> DataFrame:
    """Atoms (``ATOM_SCHEMA``) of the given parts of an index; nothing else is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _atoms(part for batch in batches for part in _rows(batch))

    return _spread(parts).mapInArrow(run, ATOM_SCHEMA)


def indexed_lines(parts: DataFrame) -> DataFrame:
    """(file, offset, line_no, value): the filled atom lines of the given parts as text, numbered by their slots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _rows(batch):
                system, path = fs.FileSystem.from_uri(part["file"])
                with system.open_input_file(path) as src:
                    data = src.read_at(part["stop"] - part["start"], part["start"])
                lines = data.decode("utf-8", "replace").replace("\r", "").split("\n")[:part["natoms"] - part["slot"]]
                kept = [(part["slot"] + i, line) for i, line in enumerate(lines) if line.strip(" ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part["file"]] * len(kept), pa.string()), pa.array([part["offset"]] * len(kept), pa.int64()),
                     pa.array([n for n, _ in kept], pa.int64()), pa.array([t for _, t in kept], pa.string())], ["file", "offset", "line_no", "value"])

    return _spread(parts).mapInArrow(run, "file string, offset bigint, line_no bigint, value string")


class IndexFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class AtomsReader(DataSourceReader):
    """Atoms of an index; an input partition is a file of the index, so the driver sees names only."""

    OPS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
    KEYS = ("file", "timestep", "frame_idx")

    def __init__(self, path: str):
        self.path, self.wanted = path, []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in self.OPS and len(f.attribute) == 1 and f.attribute[0] in self.KEYS:
                self.wanted.append((f.attribute[0], self.OPS[type(f)], list(f.value) if isinstance(f, In) else f.value))
            else:
                yield f

    def partitions(self):
        system, root = fs.FileSystem.from_uri(self.path)
        files = system.get_file_info(fs.FileSelector(root, recursive=True))
        return [IndexFile(f.path) for f in files if f.is_file and f.path.endswith(".parquet")] or [IndexFile("")]

    def read(self, partition):
        if not partition.path:
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        found = pq.read_table(partition.path, filesystem=system, filters=self.wanted or None)
        yield from _atoms(_rows(found))


class DumpAtoms(DataSource):
    """``spark.read.format("dump_atoms").load(<folder of an index's parts>)``."""

    @classmethod
    def name(cls):
        return "dump_atoms"

    def schema(self):
        return ATOM_SCHEMA

    def reader(self, schema):
        return AtomsReader(self.options["path"])


def read_index_atoms(index: FrameIndex) -> DataFrame:
    """Atoms of an index as a data source: filters on file, timestep and frame_idx choose the bytes that are read.

    The parts are written once more, a few ranges of bytes to a file.  Switches
    filter pushdown of Python data sources on in the session.
    """
    spark, folder = index.parts.sparkSession, shared_folder(index.parts)
    _spread(index.parts).write.parquet(folder)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DumpAtoms)
    # a filter that always holds: Spark plans a source anew only where filters are pushed, and would reuse those of the query before
    return spark.read.format("dump_atoms").load(folder).where("frame_idx >= 0")
