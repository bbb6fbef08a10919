"""Near-duplicates by min-max hashing, banding and exact confirmation."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.llm.common import bound_batches, stored

BANDS, ROWS = 50, 5
MEMO = 200_000
STEP = 1024  # shingles hashed at once


class WordHashes(dict):
    """64-bit hashes of words, remembered per task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        out = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def shingle_hashes(text: str | None, words_each: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of the whole text.

    A-Z are lower-cased, words end at ASCII white space.  A text with fewer
    words than a shingle has them all as its only shingle; one without words
    has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(words_each, len(ids))
    out = np.full(len(ids) - n + 1, n, np.uint64)
    for i in range(n):
        out = _scramble(out * np.uint64(0x9E3779B97F4A7C15) ^ ids[i:len(ids) - n + 1 + i])
    return np.unique(out)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def multipliers(n: int, seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def min_max(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The minima and then the maxima of a set under each permutation: two values for one evaluation.

    A permutation multiplies 32-bit hashes by an odd number of ``factors``; the shingles' sets
    themselves stay 64 bits wide.
    """
    permutations = len(factors)
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(permutations, np.iinfo(np.uint32).max, np.uint32)
    high = np.zeros(permutations, np.uint32)
    for at in range(0, len(folded), STEP):
        under = factors[:, None] * folded[None, at:at + STEP]
        np.minimum(low, under.min(axis=1), out=low)
        np.maximum(high, under.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; a band's values come from different permutations."""
    values = signature[:bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = _scramble(key * np.uint64(0x9E3779B97F4A7C15) ^ values[:, i])
    return key


def _signed(words_each: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, factors = WordHashes(), multipliers(-(-bands * rows // 2))
        for batch in batches:
            n, key, keys = [], [], []
            for text in batch.column(2):
                shingles = shingle_hashes(text.as_py(), words_each, hashes)
                n.append(len(shingles))
                key.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                keys.append(band_keys(min_max(shingles, factors), bands, rows).view(np.int64) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "text_key", "n_shingles", "set_key", "bands"])
    return run


def _sets(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            blobs = [shingle_hashes(t.as_py(), words_each, hashes).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["node", "shingles"])
    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["u", "v"])
    return run


def merge_labels(links: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over links (u > v), for the nodes that have links.

    Large-star and small-star rounds on distinct links until nothing changes;
    every grouping is by node with a minimum, combined before the shuffle.
    """
    links = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_low"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.least("_low", "u").alias("v"))
                 .where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("_low"))
        small = (large.join(low, "u").where("v > _low").select(F.col("v").alias("u"), F.col("_low").alias("v"))
                 .union(low.select("u", F.col("_low").alias("v"))).distinct())
        links = stored(small)
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of a node."""
    for batch in batches:
        for i in range(batch.num_rows):
            shingles = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64)
            same = [pa.array(np.full(len(shingles), batch.column(j)[i].as_py(), np.int64)) for j in range(3)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(shingles)], ["node", "n", "component", "e"])


def prefix_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, n, _node, _n): pairs from different components that may reach ``percent``.

    All sets are ordered alike, rare shingles first.  Sets of n and m shingles
    that share at least a = ceil(p (n + m) / (100 + p)) have a common one among
    their first n - a + 1 and m - a + 1; others are ruled out.  A far copy in a
    large group of copies begins with its own edits, so it meets few others.
    For each shingle, the rows of its largest component are not joined with
    each other.
    """
    rows = stored(nodes.select("node", "n", "component", "shingles")
                  .mapInArrow(_elements, "node bigint, n bigint, component bigint, e bigint"))
    counts = rows.groupBy("e").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    place = F.row_number().over(W.partitionBy("node").orderBy("df", "e"))
    ordered = rows.join(counts, "e", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn("pos", place)
    first = stored(ordered.where("df > 1").where(f"pos <= n - floor(({percent} * n + 99) / 100) + 1")
                   .select("e", "node", "n", "component", "pos"))
    size = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    main = first.join(size, "component").groupBy("e").agg(F.max(F.struct("members", "component")).alias("_main"))
    left = first.join(main, "e").where("component <> _main.component").drop("_main")
    right = first.select("e", *[F.col(c).alias(f"_{c}") for c in ("node", "n", "component", "pos")])
    least = F.floor((percent * (F.col("n") + F.col("_n")) + (99 + percent)) / (100 + percent))
    return left.join(right, "e").where((F.col("component") != F.col("_component")) & (F.col("pos") <= F.col("n") - least + 1)
                                       & (F.col("_pos") <= F.col("_n") - least + 1)).select("node", "n", "_node", "_n")


def near_duplicates(docs: DataFrame, *, words_each: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    stars: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document.

    Documents are linked when their whole shingle sets meet ``percent``; the
    component is the smallest id reachable.  ``bands`` of ``rows`` min-max
    values find candidates: with 50 of 5 a pair at 0.8 shares no band with
    probability 2.4e-9.  Documents with the same set are one node.  In each
    band's bucket,

    1. every node is compared with the bucket's smallest node, one pair per
       node and round in the first round (its smallest partner in any band);
    2. in ``stars`` further rounds, buckets that still hold several components
       compare a drawn node of their smallest component with all nodes outside it;
    3. at last the nodes of buckets that still hold several components are
       joined exactly: two sets can only reach the similarity if they share one
       of their rarest shingles (``prefix_pairs``).

    So each pair of nodes of one bucket is compared, connected or ruled out, and
    no link between components is lost, while the many pairs inside a large
    group of copies are never made.  Links are confirmed on full sets.

    A null text or one without words has no shingles and is its own component.
    An id with several texts is several documents: each row has the result of
    its own text.  Rows repeating an id and a text have equal results.  Null ids
    take part like others, but a component is named by its smallest id that
    isn't null; one of null ids only has a null name and all its rows are kept.
    """
    return (_components(docs, words_each, percent, bands, rows, stars, id_col, text_col)
            .select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def _components(docs: DataFrame, words_each: int, percent: int, bands: int, rows: int, stars: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, head) of every document; head is the (id, text) that stands for its component."""
    base = bound_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    signed = stored(base.mapInArrow(_signed(words_each, bands, rows),
                                    "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, bands array<bigint>"))
    # a node is a set; its number is drawn once and stored, its text is that of its least row
    least_row = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("low")
    nodes = stored(signed.where("set_key IS NOT NULL").groupBy("set_key")
                   .agg(least_row, F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()))
    keyed = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("_last")).where("head < _last").drop("_last")
    members = stored(keyed.join(shared, "key").select("key", "head", "node", "n"))
    wanted = members.select("node").distinct()
    lows = nodes.join(wanted, "node").select("node", F.col("low.doc_id").alias("_id"), F.col("low.text_key").alias("_text_key"))
    texts = base.join(lows, base["doc_id"].eqNullSafe(lows["_id"]) & (base["text_key"] == lows["_text_key"]))
    sets = stored(texts.dropDuplicates(["doc_id", "text_key"]).select("node", "text").mapInArrow(_sets(words_each), "node bigint, shingles binary"))

    def confirm(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("_a"))
        b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("_b"))
        return pairs.join(a, "u").join(b, "v").select("u", "v", "_a", "_b").mapInArrow(_confirmed(percent), "u bigint, v bigint")

    sizes_allow = 100 * F.least("n", "_n") >= percent * F.greatest("n", "_n")
    tried = stored(members.where("node > head").groupBy(F.col("node").alias("u")).agg(F.min("head").alias("v")))
    links = stored(confirm(tried))
    labels = None
    for turn in range(stars + 1):
        if links.isEmpty():
            labels = wanted.select("node", F.col("node").alias("component"))
        else:
            labels = stored(wanted.join(merge_labels(links), "node", "left")
                            .select("node", F.coalesce("component", "node").alias("component")))
        placed = members.join(labels, "node").select("key", "node", "n", "component")
        drawn = F.xxhash64("node", "key", F.lit(turn))
        split = (placed.groupBy("key").agg(F.min("component").alias("_one"), F.max("component").alias("_other"),
                                           F.min(F.struct("component", drawn.alias("draw"), "node", "n")).alias("_head"))
                 .where("_one < _other"))
        if turn < stars:
            pairs = (placed.join(split, "key").where("component <> _one")
                     .select("node", "n", F.col("_head.node").alias("_node"), F.col("_head.n").alias("_n")))
        else:
            open_ = placed.join(split.select("key"), "key").select("node", "n", "component").distinct()
            pairs = prefix_pairs(sets.join(open_, "node"), percent)
        pairs = (pairs.where(sizes_allow).select(F.greatest("node", "_node").alias("u"), F.least("node", "_node").alias("v"))
                 .distinct().join(tried, ["u", "v"], "left_anti"))
        pairs = stored(pairs)
        if turn == stars and pairs.isEmpty():
            break
        tried = tried.union(pairs)
        links = stored(links.union(confirm(pairs)))
    if not links.isEmpty():
        labels = merge_labels(links)
    named = nodes.select("set_key", "low", "node").join(labels, "node", "left").select("set_key", "low", F.coalesce("component", "node").alias("_component"))
    heads = named.groupBy("_component").agg(F.min("low").alias("head"))
    named = named.join(heads, "_component").select("set_key", "head")
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    return (signed.select("doc_id", "text_key", "n_shingles", "set_key").join(named, "set_key", "left")
            .select("doc_id", "text_key", "n_shingles", F.coalesce("head", own).alias("head"))
            .withColumn("component_id", F.col("head.doc_id")))


def drop_near_duplicates(docs: DataFrame, *, words_each: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                         stars: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one text of each component, all columns: that of the smallest id.

    Rows are known by id and text, so an id with several texts loses only those
    that repeat others.  Rows that repeat both the id and the text that stays,
    stay together; texts without words stay.
    """
    found = _components(docs, words_each, percent, bands, rows, stars, id_col, text_col)
    same = F.col("head.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("head.text_key") == F.col("text_key"))
    gone = found.where(~same).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).distinct()
    match = docs[id_col].cast("bigint").eqNullSafe(gone["__id"]) & (F.xxhash64(docs[text_col]) == gone["__text"])
    return docs.join(gone, match, "left_anti")
