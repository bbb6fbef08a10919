"""Repeated passages: merging Burrows-Wheeler transforms of shards by interleave refinement.

The plain form refines the interleave of all suffixes once per byte of depth,
so a 100-byte match means 100 passes over the corpus.  Here the strings are
first aligned, so that one pass over the columns does the same work:

* Every window of 100 bytes owns an anchor, the leftmost of its smallest hashed
  32-byte strings.  Equal windows own equal anchors at equal places.  Windows
  in a row with one anchor form a strip of at most 168 bytes, aligned so that
  its anchor starts at column 68.
* Strips whose anchor occurs once hold no repeat.  Equal strips are counted
  together, and only the first of them stays a candidate.
* The rest go, as shards, to the bucket of their anchor.  A shard carries its
  positional Burrows-Wheeler transform: column after column, the symbols in the
  order of the reversed prefixes.  A bucket merges its shards: the interleave
  for the next column is the stable partition of the present one by symbol, and
  the start of the match with the row before (the common prefix of reversed
  strings) follows from the starts between both rows.  Rows whose match covers
  100 columns form an interval, one repeated string; all but its earliest
  occurrence are removed.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import bound_batches, stored

WINDOW = 100
GRAM = 32
SPAN = WINDOW - GRAM + 1  # grams of a window; windows that can share an anchor
LEFT = SPAN - 1  # column of the anchor
COLUMNS = WINDOW + SPAN - 1
BLOCK = 1 << 20  # bytes of text looked at together
PLACE = np.uint64((1 << 24) - 1)
NO_ID = -(1 << 63)

SPANS = "kind int, doc_id bigint, tk bigint, a bigint, b bigint, lead int, starts int, anchor bigint"


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# a plain value, so that task functions carry it to workers without the package
BYTE_CODES = _scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes that start at each place, by doubling."""
    h, width = BYTE_CODES[data], 1
    while width < GRAM:
        h = h[:-width] * np.uint64((0x9E3779B97F4A7C15 * (2 * width + 1)) & (1 << 64) - 1 | 1) + h[width:]
        width *= 2
    return _scramble(h)


def anchors_of(grams: np.ndarray) -> np.ndarray:
    """For each window, the place of its anchor: least hash (40 bits), then leftmost."""
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & PLACE).astype(np.int64)


def strips(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray] | None:
    """The strips of all windows inside documents: doc, first, starts, lead, anchor and body hash.

    ``starts`` are the places of the documents in ``data``.
    """
    if len(data) < WINDOW:
        return None
    grams = gram_hashes(data)
    at = anchors_of(grams)
    ends = np.append(starts[1:], len(data))
    inside = np.zeros(len(data) + 1, np.int32)
    good = ends - starts >= WINDOW
    np.add.at(inside, starts[good], 1)
    np.add.at(inside, ends[good] - WINDOW + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:-1])[:len(at)] > 0)
    if not len(windows):
        return None
    anchor = at[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (np.diff(windows) != 1) | (np.diff(anchor) != 0)
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(windows))
    begin, place = windows[first], anchor[first]
    # the body's hash: the grams at its two ends, and steps of a gram between, cover all its bytes
    end = begin + count + WINDOW - 1
    body = grams[begin] * np.uint64(3) + grams[end - GRAM] * np.uint64(5)
    for step in range(1, -(-COLUMNS // GRAM)):
        body = _scramble(body) + grams[np.minimum(begin + step * GRAM, end - GRAM)]
    lead = place - begin
    body = _scramble(body ^ (count.astype(np.uint64) << np.uint64(8)) ^ lead.astype(np.uint64))
    return {"doc": np.searchsorted(starts, begin, side="right") - 1, "place": place, "lead": lead, "starts": count,
            "anchor": grams[place], "body": body}


def _join_runs(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in order, with those that touch or overlap made one."""
    if not len(doc):
        return doc, a, b
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (a[1:] > b[:-1])
    first = np.flatnonzero(new)
    return doc[first], a[first], np.maximum.reduceat(b, first)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Documents (id, text key, bytes) in blocks of about ``BLOCK`` bytes, each block in order."""
    block, size = [], 0
    for batch in batches:
        for doc, tk, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if len(data) < WINDOW:
                continue
            block.append((NO_ID if doc is None else doc, tk, data))
            size += len(data)
            if size >= BLOCK:
                yield sorted(set(block))
                block, size = [], 0
    if block:
        yield sorted(set(block))


def _pieces(block: list[tuple[int, int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, keys, offsets, data, starts): very long documents in parts that share 99 bytes, so that every window is in one part."""
    most = 8 * BLOCK
    group, size = [], 0
    for doc, tk, data in block:
        for at in range(0, max(1, len(data) - WINDOW + 1), most):
            part = data[at:at + most + WINDOW - 1]
            if group and size + len(part) > most + WINDOW:
                yield _joined(group)
                group, size = [], 0
            group.append((doc, tk, at, part))
            size += len(part)
    if group:
        yield _joined(group)


def _joined(group):
    lengths = np.array([len(p) for *_, p in group])
    return (np.array([g[0] for g in group], np.int64), np.array([g[1] for g in group], np.int64),
            np.array([g[2] for g in group], np.int64), np.frombuffer(b"".join(p for *_, p in group), np.uint8),
            np.concatenate([[0], np.cumsum(lengths)[:-1]]))


# one strip of a block, as it travels
STRIP = np.dtype([("anchor", "<u8"), ("body", "<u8"), ("doc", "<i8"), ("tk", "<i8"), ("place", "<i8"), ("lead", "u1"), ("starts", "u1")])


def _columns(records: np.ndarray) -> bytes:
    """Field after field, which compresses better than row after row."""
    return b"".join(np.ascontiguousarray(records[name]).tobytes() for name in records.dtype.names)


def _records(blob: bytes) -> np.ndarray:
    n, at = len(blob) // STRIP.itemsize, 0
    out = np.empty(n, STRIP)
    for name in STRIP.names:
        kind = STRIP[name]
        out[name] = np.frombuffer(blob, kind, n, at)
        at += n * kind.itemsize
    return out


def _strip_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for ids, keys, offsets, data, starts in _pieces(block):
                s = strips(data, starts)
                if s is None:
                    continue
                own = s["doc"]
                records = np.empty(len(own), STRIP)
                records["anchor"], records["body"], records["lead"], records["starts"] = s["anchor"], s["body"], s["lead"], s["starts"]
                records["doc"], records["tk"] = ids[own], keys[own]
                records["place"] = s["place"] - starts[own] + offsets[own]
                # the block is in order, so the first of equal strips is the earliest
                order = np.lexsort((records["body"], records["anchor"]))
                same = np.zeros(len(records), bool)
                same[order[1:]] = ((records["anchor"][order[1:]] == records["anchor"][order[:-1]])
                                   & (records["body"][order[1:]] == records["body"][order[:-1]]))
                out, kinds, blobs = [], [], []
                if same.any():
                    copies = records[same]
                    begin = copies["place"] - copies["lead"]
                    doc, a, b = _join_runs(own[same], begin, begin + copies["starts"] + (WINDOW - 1))
                    spans = np.stack([ids[doc], keys[doc], a, b])
                    out.append(int(records["anchor"][0] % np.uint64(buckets)))
                    kinds.append(1)
                    blobs.append(spans.tobytes())
                    records = records[~same]
                bucket = (records["anchor"] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                records, bucket = records[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                for part, b in zip(np.split(records, cuts), bucket[np.append(0, cuts)]):
                    out.append(int(b))
                    kinds.append(0)
                    blobs.append(_columns(part))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())],
                                                 ["bucket", "kind", "blob"])
    return run


def _span_table(doc, tk, a, b, *, kind: int = 0, lead=None, starts=None, anchor=None) -> pd.DataFrame:
    n = len(doc)
    zero = np.zeros(n, np.int32)
    return pd.DataFrame({"kind": np.full(n, kind, np.int32), "doc_id": doc, "tk": tk, "a": a, "b": b,
                         "lead": zero if lead is None else lead.astype(np.int32),
                         "starts": zero if starts is None else starts.astype(np.int32),
                         "anchor": np.zeros(n, np.int64) if anchor is None else anchor.view(np.int64)})


def _repeated_anchors(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: spans of later copies of a strip (kind 0), and one strip of each kind where an anchor has several (kind 1)."""
    out = []
    for blob in group.loc[group["kind"] == 1, "blob"]:
        out.append(_span_table(*np.frombuffer(blob, np.int64).reshape(4, -1)))
    blobs = list(group.loc[group["kind"] == 0, "blob"])
    if blobs:
        r = np.concatenate([_records(b) for b in blobs])
        r = r[np.lexsort((r["place"], r["tk"], r["doc"], r["body"], r["anchor"]))]
        again = np.zeros(len(r), bool)  # rows that repeat an id and a text are one document
        again[1:] = r[1:] == r[:-1]
        r = r[~again]
        new_anchor = np.ones(len(r), bool)
        new_anchor[1:] = r["anchor"][1:] != r["anchor"][:-1]
        new_body = new_anchor.copy()
        new_body[1:] |= r["body"][1:] != r["body"][:-1]
        later = r[~new_body]
        later = later[np.lexsort((later["place"], later["tk"], later["doc"]))]
        begin = later["place"] - later["lead"]
        new = np.ones(len(later), bool)
        new[1:] = (later["doc"][1:] != later["doc"][:-1]) | (later["tk"][1:] != later["tk"][:-1])
        doc, a, b = _join_runs(np.cumsum(new), begin, begin + later["starts"] + (WINDOW - 1))
        head = later[np.flatnonzero(new)]
        out.append(_span_table(head["doc"][doc - 1], head["tk"][doc - 1], a, b))
        kinds = np.add.reduceat(new_body.astype(np.int64), np.flatnonzero(new_anchor))
        several = (kinds > 1)[np.cumsum(new_anchor) - 1] & new_body
        ask = r[several]
        out.append(_span_table(ask["doc"], ask["tk"], ask["place"], ask["place"], kind=1, lead=ask["lead"], starts=ask["starts"],
                               anchor=np.ascontiguousarray(ask["anchor"])))
    return pd.concat(out, ignore_index=True) if out else _span_table(*[np.zeros(0, np.int64)] * 4)


def transform(rows: np.ndarray) -> np.ndarray:
    """The positional transform of aligned strings (strings x columns): symbols of each column in the order of the reversed prefixes."""
    out = np.empty(rows.shape[::-1], np.uint8)
    order = np.arange(len(rows))
    for j in range(rows.shape[1]):
        column = rows[order, j]
        out[j] = column
        order = order[np.argsort(column, kind="stable")]
    return out


def _greatest_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """max(values[low..high]) for each pair, from a table of power-of-two runs."""
    level = np.floor(np.log2(high - low + 1)).astype(np.int64)
    out = np.empty(len(low), values.dtype)
    run = values
    for k in range(int(level.max()) + 1 if len(level) else 0):
        here = level == k
        if here.any():
            out[here] = np.maximum(run[low[here]], run[high[here] - (1 << k) + 1])
        run = np.maximum(run[:-(1 << k)], run[1 << k:]) if len(run) > 1 << k else run
    return out


def merge_shards(shards: list[np.ndarray], first: np.ndarray, starts: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which windows of which string also occur earlier (strings x ``SPAN``).

    ``shards`` are transforms; ``first`` and ``starts`` give the columns where a
    string's windows start, ``rank`` the order of occurrence; all in the order
    of the shards and, inside a shard, of its strings.
    """
    n = len(rank)
    symbols = np.concatenate(shards, axis=1)
    source = np.repeat(np.arange(len(shards)), [s.shape[1] for s in shards])
    source = source.astype(np.uint16 if len(shards) < 1 << 16 else np.int64)
    strings = np.arange(n)
    match = np.zeros(n, np.int16)  # first column of the match with the row before
    removed = np.zeros((n, SPAN), bool)
    last = np.int64(np.iinfo(np.int64).max)
    for j in range(COLUMNS):
        column = np.empty(n, np.uint8)
        column[np.argsort(source, kind="stable")] = symbols[j]
        order = np.argsort(column, kind="stable")
        sorted_ = column[order]
        fresh = np.empty(n, np.int16)
        fresh[0] = j + 1
        same = sorted_[1:] == sorted_[:-1]
        fresh[1:][~same] = j + 1
        fresh[1:][same] = _greatest_between(match, order[:-1][same] + 1, order[1:][same])
        match, source, strings = fresh, source[order], strings[order]
        c = j - WINDOW + 1
        if c < 0:
            continue
        own = (first[strings] <= c) & (c < first[strings] + starts[strings])
        ranks = np.where(own, rank[strings], last)
        begin = match > c
        begin[0] = True
        earliest = np.minimum.reduceat(ranks, np.flatnonzero(begin))[np.cumsum(begin) - 1]
        removed[strings, c] = own & (ranks > earliest)
    return removed


def _shard_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, about = [], []
            for doc, tk, text, asked in zip(*(batch.column(i) for i in range(4))):
                data = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                place, lead, count, anchor = (np.asarray(x) for x in asked.values.flatten())
                padded = np.concatenate([np.zeros(LEFT, np.uint8), data, np.zeros(COLUMNS, np.uint8)])
                column = np.arange(COLUMNS)
                rows = padded[place[:, None] + column]
                begin = LEFT - lead
                rows[(column < begin[:, None]) | (column >= (begin + count + WINDOW - 1)[:, None])] = 0
                pieces.append(rows)
                about.append(np.stack([np.full(len(place), NO_ID if doc.as_py() is None else doc.as_py(), np.int64),
                                       np.full(len(place), tk.as_py(), np.int64), place.astype(np.int64), lead.astype(np.int64),
                                       count.astype(np.int64), anchor.astype(np.int64)]))
            if not pieces:
                continue
            rows, about = np.concatenate(pieces), np.concatenate(about, axis=1)
            bucket = (about[5].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            out = [[], [], []]
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for part in np.split(order, cuts):
                for column, value in zip(out, (int(bucket[part[0]]), about[:5, part].tobytes(), transform(rows[part]).tobytes())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
                                             ["bucket", "about", "columns"])
    return run


def _merged_spans(group: pd.DataFrame) -> pd.DataFrame:
    about = np.concatenate([np.frombuffer(x, np.int64).reshape(5, -1) for x in group["about"]], axis=1)
    shards = [np.frombuffer(x, np.uint8).reshape(COLUMNS, -1) for x in group["columns"]]
    doc, tk, place, lead, count = about
    rank, order = np.empty(about.shape[1], np.int64), np.lexsort((place, tk, doc))
    step = np.any(np.diff(about[:3, order], axis=1) != 0, axis=0)  # a repeated row has the same rank
    rank[order] = np.concatenate([[0], np.cumsum(step)])
    removed = merge_shards(shards, LEFT - lead, count, rank)
    edge = np.diff(np.pad(removed, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    at, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    shift = place[at] - LEFT
    return _span_table(doc[at], tk[at], begin + shift, end + shift + (WINDOW - 1))


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for doc, text, spans in zip(*(batch.column(i) for i in range(3))):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            kept, at, gone, runs = [], 0, 0, []
            for a, b in sorted((s["a"], s["b"]) for s in spans.as_py() or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(b, runs[-1][1])
                else:
                    runs.append([a, b])
            for a, b in runs:
                kept.append(data[at:a])
                at, gone = b, gone + b - a
            kept.append(data[at:])
            for column, value in zip(out, (doc.as_py(), len(data), gone, runs, hashlib.sha256(b"".join(kept)).hexdigest())):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                          pa.array(out[3], pa.list_(pa.list_(pa.int64()))), pa.array(out[4], pa.string())],
                                         ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, *, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tk, a, b): byte ranges covered by a 100-byte string that also starts earlier; they may overlap.

    ``tk`` is the 64-bit hash of the text; a null id is the smallest number.
    """
    spark = docs.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _with_key(docs, id_col, text_col)
    strips_ = rows.mapInArrow(_strip_rows(buckets), "bucket int, kind int, blob binary")
    found = stored(strips_.groupBy("bucket").applyInPandas(_repeated_anchors, SPANS))
    asked = (found.where("kind = 1").groupBy("doc_id", "tk")
             .agg(F.collect_list(F.struct(F.col("a").alias("place"), "lead", "starts", "anchor")).alias("asked")))
    texts = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "tk", "text")
    shards = (texts.join(asked, ["doc_id", "tk"]).select("doc_id", "tk", "text", "asked")
              .mapInArrow(_shard_rows(buckets), "bucket int, about binary, columns binary"))
    merged = stored(shards.groupBy("bucket").applyInPandas(_merged_spans, SPANS))
    return found.where("kind = 0").union(merged).select("doc_id", "tk", "a", "b")


def _with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(text_col, F.lit(""))
    return bound_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tk"), text.alias("text"))


def remove_repeats(docs: DataFrame, *, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is left of each document without the bytes of strings that also start earlier.

    Earlier means in a smaller id, or in the same document at a smaller place.
    Columns: id, n_bytes, n_removed, spans (maximal removed runs of UTF-8
    bytes) and kept_sha256.  A null text counts as empty; texts below 100 bytes
    lose nothing; a null id comes before all others.  Rows that repeat an id
    with other texts follow by a hash of the text; rows that repeat both are
    one document.
    """
    spans = (repeated_spans(docs, buckets=buckets, id_col=id_col, text_col=text_col)
             .groupBy("doc_id", "tk").agg(F.collect_list(F.struct("a", "b")).alias("spans")))
    rows = _with_key(docs, id_col, text_col)
    joined = (rows.withColumn("_id", F.coalesce("doc_id", F.lit(NO_ID)))
              .join(spans.select(F.col("doc_id").alias("_id"), "tk", "spans"), ["_id", "tk"], "left"))
    out = joined.select("doc_id", "text", "spans").mapInArrow(
        _kept_rows, "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<array<bigint>>, kept_sha256 string")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)
