"""Language identification by nearest centroids of TF-IDF n-gram vectors."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.llm.common import bound_batches

DIMS = 1 << 13
ORDERS = (1, 2, 3)
CHUNK = 128  # documents weighted at once


# where letters begin and end among the code points: a small plain value, so that task functions carry it
LETTER_EDGES = np.flatnonzero(np.diff(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000), prepend=False)).astype(np.int32)
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """True where a code point is a letter."""
    if "letters" not in _tables:
        steps = np.zeros(0x110000, np.uint8)
        steps[LETTER_EDGES] = 1
        _tables["letters"] = (np.cumsum(steps, dtype=np.uint8) & 1).astype(bool)
    return _tables["letters"]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of the n-grams of the lower-cased whole text; None without a letter.

    Everything but letters counts as one kind of blank; n-grams of blanks only are left out.
    """
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    counts = np.zeros(DIMS, np.int64)
    gram, some = np.zeros(len(codes), np.uint32), np.zeros(len(codes), bool)
    for n in range(1, max(ORDERS) + 1):
        if len(codes) < n:
            break
        gram = gram[:len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1:]
        some = some[:len(codes) - n + 1] | letter[n - 1:]
        if n in ORDERS:
            place = ((gram + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)
            counts += np.bincount(place[some], minlength=DIMS)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length 1 from rows of counts: dampened counts times idf."""
    out = np.log1p(counts).astype(np.float32) * idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def cluster_centroids(rows: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Spherical k-means: at most ``k`` unit centroids of unit rows."""
    k = min(k, len(rows))
    centers = rows[np.random.default_rng(seed).choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(rows @ centers.T, axis=1)
        sums = np.stack([rows[nearest == j].sum(axis=0) if (nearest == j).any() else centers[j] for j in range(k)])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centers.astype(np.float32)


@dataclass
class LanguageModel:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # several rows per language
    owner: np.ndarray  # language of each row
    floor: np.ndarray  # least cosine of each language that isn't rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine to its nearest centroid (0 to 1) and whether it lies too far from it."""
        pred, score, far = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        for at in range(0, len(texts) if self.langs else 0, CHUNK):
            found = [(at + i, c) for i, t in enumerate(texts[at:at + CHUNK]) if (c := ngram_counts(t)) is not None]
            if not found:
                continue
            cosine = weigh(np.stack([c for _, c in found]), self.idf) @ self.centroids.T
            best = np.argmax(cosine, axis=1)
            for (i, _), j, row in zip(found, best, cosine):
                lang, value = self.owner[j], float(min(1.0, max(0.0, row[j])))
                pred[i], score[i], far[i] = self.langs[lang], value, bool(value < self.floor[lang])
        return pred, score, far


def _df_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per feature and task: in how many documents it occurs; feature -1 counts the documents."""
    total, docs = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            counts = ngram_counts(text.as_py())
            if counts is not None:
                total += counts > 0
                docs += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS)), pa.array(np.concatenate([[docs], total]))], ["feature", "n"])


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, at, n = [], [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = ngram_counts(text)
            if counts is not None:
                places = np.flatnonzero(counts)
                langs.append(lang)
                at.append(places.astype(np.int16).tolist())
                n.append(counts[places].astype(np.int32).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(at, pa.list_(pa.int16())), pa.array(n, pa.list_(pa.int32()))], ["lang", "at", "n"])


def fold_of(id_col: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def thinned(rows: DataFrame, group: str, per_group: int, tie: list[str], seed: int = 11) -> DataFrame:
    """At most ``per_group`` rows of each group, by a hash of ``tie``.

    The rate is set from the group's count first, so no window holds more than
    a few times ``per_group`` rows.
    """
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    draw = F.pmod(F.xxhash64(*tie, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    few = rows.withColumn("_draw", draw).join(F.broadcast(counts), group).where(F.col("_draw") * F.col("_n") < 2.0 * per_group)
    place = F.row_number().over(W.partitionBy(group).orderBy("_draw", *tie))
    return few.withColumn("_place", place).where(F.col("_place") <= per_group).drop("_n", "_draw", "_place")


def fit_languages(train: DataFrame, *, sample: int = 3000, per_lang: int = 600, centroids: int = 4, rounds: int = 8,
                  reject: float = 0.005, seed: int = 5, text_col: str = "text", lang_col: str = "lang",
                  id_col: str = "doc_id") -> LanguageModel:
    """Learn from the rows of ``train`` with a language.

    The document frequencies cover all rows.  The centroids are fitted on at
    most ``per_lang`` documents with a letter of a language and ``sample``
    together; that sample is what reaches the driver.  Rows with a null id
    count in the frequencies only.
    """
    rows = bound_batches(train).where(F.col(lang_col).isNotNull())
    langs = sorted(r[0] for r in rows.select(lang_col).distinct().collect())
    idf = np.ones(DIMS, np.float32)
    if not langs:
        return LanguageModel([], idf, np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
    df = {r["feature"]: r["n"] for r in rows.select(text_col).mapInArrow(_df_rows, "feature bigint, n bigint")
          .groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    docs = df.get(-1, 0)
    idf = np.log((1 + docs) / (1 + np.array([df.get(i, 0) for i in range(DIMS)], float))).astype(np.float32) + 1
    each = max(1, min(per_lang, sample // len(langs)))
    lettered = rows.where(F.col(text_col).rlike(r"\p{L}"))  # others can't be learned from
    ids = thinned(lettered.select(lang_col, id_col), lang_col, each, [id_col]).select(id_col).distinct()
    few = rows.join(F.broadcast(ids), id_col).select(F.col(lang_col).cast("string").alias("lang"), text_col)
    by_lang: dict[str, list] = {}
    for r in few.mapInArrow(_sparse_rows, "lang string, at array<smallint>, n array<int>").collect():
        by_lang.setdefault(r["lang"], []).append((r["at"], r["n"]))
    known, centers, owner, floor = [], [], [], []
    for lang in langs:
        if lang not in by_lang:
            continue
        counts = np.zeros((len(by_lang[lang]), DIMS), np.float32)
        for i, (at, n) in enumerate(sorted(by_lang[lang])):
            counts[i, at] = n
        unit = weigh(counts, idf)
        own = cluster_centroids(unit, centroids, rounds, seed)
        owner += [len(known)] * len(own)
        known.append(lang)
        centers.append(own)
        floor.append(float(np.quantile((unit @ own.T).max(axis=1), reject)))
    return LanguageModel(known, idf, np.concatenate(centers) if centers else np.zeros((0, DIMS), np.float32),
                         np.array(owner, int), np.array(floor))


def predict_languages(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) of every whole text.

    ``und`` where a text is null or has no letter (and where nothing was
    learned).  A text further from every centroid than nearly all that its
    language was learned from is marked ``rejected``.  Repeated rows are
    predicted alike; an empty table gives an empty result.
    """
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast([astuple(model), None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value[1] is None:  # plain values reach workers without the package
            shared.value[1] = LanguageModel(*shared.value[0])
        for batch in batches:
            pred, score, far = shared.value[1].predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()),
                                              pa.array(score, pa.float64()), pa.array(far, pa.bool_())],
                                             ["id", "held_out", "lang_pred", "score", "rejected"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), (fold_of(id_col) == 0).alias("held_out"), text_col)
            .mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
            .withColumnRenamed("id", id_col))
