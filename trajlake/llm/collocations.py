"""Phrase collocations: counts by tries of word ids, spilled as sorted runs and merged per prefix partition."""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.llm.common import bound_batches, stored
from trajlake.llm.word_trie import WordTrie

CHUNK = 1 << 22  # bytes of text taken together
STEP = 1 << 19  # words counted at once
WORDS = 1 << 20  # words of a task's vocabulary; with those of a slice they must stay below 2 ** BITS
FILTER = 27  # binary logarithm of the bits of the filter of frequent pairs
SALTS = 64
# fixed values: what separates pieces, and what separates words
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TABLE = bytes.maketrans(CAPITALS + PIECE_ENDS + BLANKS, CAPITALS.lower() + b"." * len(PIECE_ENDS) + b" " * len(BLANKS))


class Vocabulary:
    """Words of a task numbered from 1 by language, with 64-bit ids that all tasks agree on; number 0 ends a piece."""

    class Of(dict):
        def __init__(self, lang: str, add):
            super().__init__({b".": 0})
            self.lang, self.new = lang, add

        def __missing__(self, word: bytes) -> int:
            number = self[word] = self.new(self.lang, word)
            return number

    def __init__(self):
        self.langs: dict[str, Vocabulary.Of] = {}
        self.names: list[tuple[str, bytes]] = [("", b".")]
        self.hashes: list[bytes] = [bytes(16)]
        self.n = np.zeros(1, np.int64)
        self.ids = np.zeros(1, np.uint64)

    def _add(self, lang: str, word: bytes) -> int:
        self.names.append((lang, word))
        self.hashes.append(blake2b(lang.encode() + b" " + word, digest_size=16).digest())
        return len(self.names) - 1

    def numbers(self, lang: str, words: list[bytes]) -> np.ndarray:
        """The words as numbers, 0 between pieces."""
        own = self.langs.setdefault(lang, self.Of(lang, self._add))
        out = np.fromiter(map(own.__getitem__, words), np.int64, len(words))
        if len(self.hashes) > len(self.ids):
            new = np.frombuffer(b"".join(self.hashes[len(self.ids):]), "<u8")
            self.ids = np.concatenate([self.ids, new[::2]])
            self.n = np.concatenate([self.n, np.zeros(len(new) // 2, np.int64)])
        return out


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(lang, words, n): words of whole texts in slices of at most ``STEP``, each followed by what phrases begun in it need."""
    for lang, texts in _chunks(batches):
        words = b".".join(texts).translate(TABLE).replace(b".", b" . ").split()
        for at in range(0, len(words), STEP):
            yield lang, words[at:at + STEP + width - 1], min(STEP, len(words) - at)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Whole texts by language, some megabytes together."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= CHUNK or sum(size.values()) >= 4 * CHUNK:
                most = max(size, key=size.get)
                size.pop(most)
                yield most, held.pop(most)
    yield from held.items()


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64) if values.dtype != np.uint64 else values.view(np.int64))


PAIRS = "w1 bigint, w2 bigint, n bigint, twin bigint, lang_id bigint, lang string, word string"
TRIPLES = "w1 bigint, w2 bigint, w3 bigint, n bigint"


def _pair_runs(limits: dict):
    """Runs of pairs (w1, w2, n) and the words with their counts (w2 null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, trie = Vocabulary(), WordTrie(2, **limits)

        def rows(keys: np.ndarray, n: np.ndarray):
            none = pa.nulls(len(keys), pa.int64())
            text = pa.nulls(len(keys), pa.string())
            return pa.RecordBatch.from_arrays([*[_longs(words.ids[w]) for w in trie.words(keys)], _longs(n), none, none, text, text],
                                              [f.split()[0] for f in PAIRS.split(", ")])

        def vocabulary():
            if len(words.names) > 1:
                langs = pa.array([lang for lang, _ in words.names[1:]], pa.string())
                ids = {lang: int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little", signed=True) for lang in words.langs}
                twins = np.frombuffer(b"".join(words.hashes[1:]), "<u8")[1::2]
                yield pa.RecordBatch.from_arrays(
                    [_longs(words.ids[1:]), pa.nulls(len(langs), pa.int64()), _longs(words.n[1:]), _longs(twins),
                     pa.array([ids[lang] for lang, _ in words.names[1:]], pa.int64()), langs,
                     pa.array([w for _, w in words.names[1:]], pa.binary()).cast(pa.string())], [f.split()[0] for f in PAIRS.split(", ")])

        for lang, some, own in _slices(batches, 2):
            at = words.numbers(lang, some)
            words.n += np.bincount(at[:own], minlength=len(words.n))
            pair = (at[:-1] > 0) & (at[1:] > 0)
            for part in trie.add(trie.key([at[:-1][pair], at[1:][pair]])):
                yield rows(*part)
            if len(words.names) > WORDS:
                yield from (rows(*part) for part in trie.spill())
                yield from vocabulary()
                words = Vocabulary()
        yield from (rows(*part) for part in trie.spill())
        yield from vocabulary()
    return run


def _places(w1: np.ndarray, w2: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a pair in the filter."""
    h = (w1 * np.uint64(0xD6E8FEB86659FD93) ^ (w1 >> np.uint64(29))) + w2
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h >> np.uint64(64 - bits), (h & np.uint64((1 << 32) - 1)) * np.uint64(0x9E3779B1) & np.uint64((1 << bits) - 1)


def pair_filter(pairs: DataFrame, bits: int = FILTER) -> np.ndarray:
    """A Bloom filter of all pairs, 2 ** ``bits`` bits whatever their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w1, w2 = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            places = np.unique(np.concatenate(_places(w1, w2, bits)))
            slot, first = np.unique(places >> np.uint64(6), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first) if len(places) else places
            yield pa.RecordBatch.from_arrays([_longs(slot), _longs(mask)], ["slot", "mask"])

    rows = pairs.select("w1", "w2").mapInArrow(run, "slot bigint, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["slot"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return out


def _triple_runs(shared, bits: int, limits: dict):
    """Runs of triples whose two pairs pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words, trie = shared.value, Vocabulary(), WordTrie(3, **limits)

        def rows(keys: np.ndarray, n: np.ndarray):
            return pa.RecordBatch.from_arrays([*[_longs(words.ids[w]) for w in trie.words(keys)], _longs(n)], ["w1", "w2", "w3", "n"])

        for lang, some, _ in _slices(batches, 3):
            at = words.numbers(lang, some)
            pair = np.flatnonzero((at[:-1] > 0) & (at[1:] > 0))
            passed = np.zeros(len(at), bool)
            hit = np.ones(len(pair), bool)
            for place in _places(words.ids[at[pair]], words.ids[at[pair + 1]], bits):
                hit &= (known[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            passed[pair[hit]] = True
            start = np.flatnonzero(passed[:-1] & passed[1:])
            for part in trie.add(trie.key([at[start], at[start + 1], at[start + 2]])):
                yield rows(*part)
            if len(words.names) > WORDS:
                yield from (rows(*part) for part in trie.spill())
                words = Vocabulary()
        yield from (rows(*part) for part in trie.spill())
    return run


def _merged(runs: DataFrame, words: list[str]) -> DataFrame:
    """Runs merged per prefix partition: all words but the last, and six bits of the last, so that a frequent prefix is split."""
    prefix = F.xxhash64(*words[:-1], F.shiftrightunsigned(words[-1], 58))
    return (runs.withColumn("prefix", prefix).repartition("prefix").groupBy("prefix", *words).agg(F.sum("n").alias("a")).drop("prefix"))


def _cut(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in exact decimals."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, *, least: int = 10, percent: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 filter_bits: int = FILTER, burst: int = 1 << 16, most: int = 1 << 21) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words of each language.

    One pass counts words and pairs, a second triples.  A triple can only be
    seen ``least`` times if both its pairs are, so the second pass skips those
    that a Bloom filter of the frequent pairs rules out; its size is fixed, and
    what it lets through by mistake is counted right all the same.  Null texts
    are empty, null languages ``und``; repeated rows count each time; an empty
    table gives an empty result.
    """
    limits = {"burst": burst, "most": most}
    texts = bound_batches(docs).select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    runs = stored(texts.mapInArrow(_pair_runs(limits), PAIRS))
    words = runs.where("w2 is null")
    n = words.groupBy("lang_id", "lang").agg(F.sum("n").alias("n"))
    same = F.when(F.min("twin") == F.max("twin"), F.sum("n")).otherwise(F.raise_error(F.lit("two words share a 64-bit id")).cast("bigint"))
    singles = stored(words.groupBy("w1").agg(same.alias("f"), F.min("lang_id").alias("lang_id")).where(F.col("f") >= least))
    pairs = stored(_merged(runs.where("w2 is not null").select("w1", "w2", "n"), ["w1", "w2"]).where(F.col("a") >= least))
    shared = docs.sparkSession.sparkContext.broadcast(pair_filter(pairs, filter_bits))
    triples = stored(_merged(texts.mapInArrow(_triple_runs(shared, filter_bits, limits), TRIPLES), ["w1", "w2", "w3"]).where(F.col("a") >= least))

    def single(at: str, f: str) -> DataFrame:
        return singles.select(F.col("w1").alias(at), F.col("f").alias(f), *([F.col("lang_id")] if at == "w1" else []))

    two = (pairs.join(single("w1", "l"), "w1").join(single("w2", "r"), "w2")
           .withColumns({"score": _cut(F.col("a"), F.col("l"), F.col("r")), "w3": F.lit(None).cast("bigint")}))
    longer = (triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
              .groupBy("w1", "w2").agg(F.max("a").alias("_longer")))
    two = two.join(longer, ["w1", "w2"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < percent * F.col("a"))).drop("_longer")
    three = (triples.join(pairs.withColumnRenamed("a", "l2"), ["w1", "w2"])
             .join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1")), ["w2", "w3"])
             .join(single("w1", "l1"), "w1").join(single("w3", "r2"), "w3"))
    one, other = _cut(F.col("a"), F.col("l1"), F.col("r1")), _cut(F.col("a"), F.col("l2"), F.col("r2"))
    three = (three.withColumns({"s1": one, "s2": other})
             .withColumns({"score": F.least("s1", "s2"), "l": F.when(F.col("s1") <= F.col("s2"), F.col("l1")).otherwise(F.col("l2")),
                           "r": F.when(F.col("s1") <= F.col("s2"), F.col("r1")).otherwise(F.col("r2"))}))
    columns = ["lang_id", "w1", "w2", "w3", "a", "l", "r", "score"]
    best = two.select(columns).unionByName(three.select(columns)).withColumn("salt", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS)))
    order = [F.col("score").desc(), F.col("a").desc()]
    # of a salt at most the first ones and their ties can be among the first of all
    for groups in (["lang_id", "salt"], ["lang_id"]):
        best = best.withColumn("_place", F.rank().over(W.partitionBy(*groups).orderBy(*order))).where(F.col("_place") <= top).drop("_place")
    best = stored(best.drop("salt"))
    wanted = best.select(F.explode(F.array_compact(F.array("w1", "w2", "w3"))).alias("w1")).distinct()
    spelled = words.join(wanted, "w1", "left_semi").groupBy("w1").agg(F.min("word").alias("word"))
    for at in ("w1", "w2", "w3"):
        best = best.join(spelled.select(F.col("w1").alias(at), F.col("word").alias(f"{at}_word")), at, "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "w1_word", "w2_word", "w3_word")).join(n, "lang_id")
    place = F.row_number().over(W.partitionBy("lang_id").orderBy(*order, "phrase"))
    return (best.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
