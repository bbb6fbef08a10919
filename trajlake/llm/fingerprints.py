"""Document fingerprints by locally consistent parsing."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import bound_batches

KEPT = 64  # phrase names of a fingerprint
FIRST = 2  # lowest level whose names count
CHUNK = 200_000  # code points parsed at once


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit name from a 64-bit number (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss_table() -> np.ndarray:
    """label for (left label, own label) below 128: twice the lowest place where they differ, plus the own bit there."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = left ^ own
    place = np.bitwise_count((differ & -differ) - 1).astype(int) % 8
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).ravel()


TOSS = _toss_table()  # a plain value, so that task functions carry it to workers without the package


def coin_labels(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels below 8 by three rounds of deterministic coin tossing.

    A label depends on the symbol and the three to its left only; the left of a
    document's first symbol is a fixed symbol, so documents don't see each other.
    """
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[starts] = ~x[starts]
    differ = left ^ x
    place = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint64) & np.uint64(63)
    label = ((place << np.uint64(1)) | ((x >> place) & np.uint64(1))).astype(np.uint8)
    table = TOSS
    for _ in range(2):
        left = np.empty_like(label)
        left[1:] = label[:-1]
        left[starts] = label[starts] ^ 1
        label = table[left.astype(np.uint16) << np.uint16(7) | label]
    return label


def parse_level(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, starts) of the next level; ``starts`` are the places of the documents' first symbols.

    Runs of one symbol become one symbol; phrases then begin where the label is
    a strict local maximum.  A name depends on the phrase's symbols only, and a
    phrase of one symbol keeps its name.
    """
    change = np.empty(len(x), bool)
    change[0], change[1:] = True, x[1:] != x[:-1]
    change[starts] = True
    at = np.flatnonzero(change)
    if len(at) < len(x):
        run = np.diff(at, append=len(x)).astype(np.uint64)
        starts = np.searchsorted(at, starts)
        x = x[at]
        x = np.where(run > 1, _mix(x * np.uint64(3) + run), x)
    label = coin_labels(x, starts)
    head = np.zeros(len(x), bool)
    head[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    head[starts[1:] - 1] = False  # the last symbol of a document has no right neighbour
    head[starts] = True
    at = np.flatnonzero(head)
    size = np.diff(at, append=len(x))
    inside = np.arange(len(x)) - np.repeat(at, size)
    names = np.add.reduceat(_mix(x ^ (inside.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))), at)
    names = np.where(size > 1, _mix(names), x[at])
    return names, np.searchsorted(at, starts)


def fingerprints(texts: list[str]) -> list[tuple[int, ...]]:
    """The ``KEPT`` smallest 32-bit phrase names of each text, over all levels from ``FIRST`` up to its one name."""
    out: list[tuple[int, ...]] = [()] * len(texts)
    group, size = [], 0
    for i, text in enumerate(texts):
        if text:
            group.append(i)
            size += len(text)
        if group and (size >= CHUNK or i == len(texts) - 1):
            for j, names in zip(group, _parse([texts[j] for j in group])):
                out[j] = names
            group, size = [], 0
    return out


def _parse(texts: list[str]) -> list[tuple[int, ...]]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    x = _mix(codes.astype(np.uint64))
    doc = np.arange(len(texts))
    found, level = [], 0
    while len(doc):
        x, starts = parse_level(x, starts)
        level += 1
        sizes = np.diff(starts, append=len(x))
        # the names a document ends with count at whatever level it ends
        use = np.ones(len(x), bool) if level >= FIRST else np.repeat(sizes == 1, sizes)
        names = _mix(x) >> np.uint64(32)
        found.append((np.repeat(doc, sizes).astype(np.uint64)[use] << np.uint64(32)) | names[use])
        more = sizes > 1
        keep = np.repeat(more, sizes)
        x, doc = x[keep], doc[more]
        starts = np.concatenate([[0], np.cumsum(sizes[more])[:-1]]).astype(int) if len(doc) else np.zeros(0, int)
    keys = np.unique(np.concatenate(found))
    owner = (keys >> np.uint64(32)).astype(int)
    ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
    begins = np.searchsorted(owner, np.arange(len(texts)), side="left")
    names = (keys & np.uint64(0xFFFFFFFF))
    return [tuple(names[a:min(b, a + KEPT)].tolist()) for a, b in zip(begins, ends)]


def written(names: tuple[int, ...]) -> str:
    """A fingerprint as text: eight hex digits a name, in ascending order."""
    return "".join(f"{n:08x}" for n in names)


def likeness(a: tuple[int, ...], b: tuple[int, ...]) -> float:
    """Share of common phrases among the ``KEPT`` smallest names of both (0 to 1); two empty texts are alike."""
    if a == b:
        return 1.0
    one, two = set(a), set(b)
    union = sorted(one | two)[:KEPT]
    return sum(n in one and n in two for n in union) / len(union)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, tail, doc_id, text) in order; of a chunk, the first tail row only serves as the next text."""
    held = None  # the row before, whose next text isn't known yet
    rows: list[tuple] = []  # (chunk, doc_id, text, next text)
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal rows, size
        texts = [r[2] for r in rows]
        changed = [edited(r[2], r[3]) for r in rows]
        prints = fingerprints(texts + changed + [r[3] for r in rows if r[4]])
        own, other, tails = prints[:len(rows)], prints[len(rows):2 * len(rows)], iter(prints[2 * len(rows):])
        # the next row of most rows stands in the list as well
        after = [next(tails) if r[4] else own[i + 1] for i, r in enumerate(rows)]
        out = pa.RecordBatch.from_arrays([
            pa.array([r[1] for r in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed], pa.string()),
            pa.array(map(written, own), pa.string()), pa.array(map(written, other), pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        rows, size = [], 0
        return out

    for batch in batches:
        for chunk, tail, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held is not None and held[0] == chunk:
                rows.append((*held, text, False))
                size += len(held[2])
                held = None
                if tail or size >= CHUNK:
                    rows[-1] = (*rows[-1][:4], True)
                    yield flush()
            if not tail:
                held = (chunk, doc, text)
    if rows:
        raise AssertionError("a chunk without a tail row")


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                          chunks: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited text, and compare with the next document's.

    Documents are cut by id into ``chunks`` ranges (by default as many as
    shuffle partitions) at approximate quantiles, which are ids that occur.
    The texts move once, to their range; the first document of a range moves
    also to the range before it, the very first to the last.  A range is read
    as a stream that holds two texts and one block of results.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  A null text counts as empty and has an empty
    fingerprint; empty texts are alike (1.0) with each other only.  Null ids
    come first, equal ids are ordered by their texts.  A single document
    follows itself; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    chunks = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = bound_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / chunks for i in range(1, chunks)] or [0.5], 100 * chunks).alias("cuts"),
                    F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    bounds = sorted({c for c in cuts["cuts"] or [] if cuts["nulls"] or c > cuts["low"]} if chunks > 1 else ())
    last = len(bounds)
    limits = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    chunk = F.coalesce(F.size(F.filter(limits, lambda b: b <= F.col("doc_id"))), F.lit(0))
    # the document that opens a range closes the range before it
    first = F.col("doc_id").isNull() if cuts["nulls"] else F.col("doc_id") == F.lit(cuts["low"])
    opens = F.array_contains(limits, F.col("doc_id")) if bounds else F.lit(False)
    spread = F.array_compact(F.array(
        F.struct(chunk.alias("chunk"), F.lit(False).alias("tail")),
        F.when(opens, F.struct((chunk - 1).alias("chunk"), F.lit(True).alias("tail"))),
        F.when(first, F.struct(F.lit(last).alias("chunk"), F.lit(True).alias("tail")))))
    dealt = (rows.select("doc_id", "text", F.explode(spread).alias("_to"))
             .select("_to.chunk", "_to.tail", "doc_id", "text")
             .repartitionByRange(max(chunks, last + 1), "chunk").sortWithinPartitions("chunk", "tail", "doc_id", "text"))
    out = dealt.mapInArrow(_pairs, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)
