"""Document quality from a linear-chain conditional random field over lines."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import bound_batches
from trajlake.llm.language import fold_of, thinned

SHARE = (0.0, 0.003, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5, 0.7)
EDGES = np.array([
    (2.3, 3.0, 3.4, 3.8, 4.2, 4.7, 5.3, 6.0, 7.0, 8.0),  # logarithm of the bytes
    *[SHARE] * 4,  # capitals among letters, digits, stops, other signs
    tuple(1 - x for x in reversed(SHARE)),  # letters
    *[SHARE] * 2,  # repeated words, words equal to the one before
    (2.5, 3.5, 4.5, 5.5, 6.5, 7.5, 8.5, 10.0, 13.0, 20.0),  # bytes a word
    *[SHARE] * 2,  # exclamation marks a word, bytes that aren't ASCII
    (0.5,) * len(SHARE),  # whether the document had the line before
])
STATS, BINS = len(EDGES), len(SHARE) + 1
MOST_LINES = 2000  # of an example
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
DIGITS = b"0123456789"
STOPS = b".,;:!?'\"()-"
BLANKS = b" \t\x0b\x0c\r"
HIGH = bytes(range(128, 256))


def lines_of(text: str | None) -> list[str]:
    """The lines with a character that isn't blank."""
    return [line for line in (text or "").split("\n") if line.strip()]


def line_stats(lines: list[str]) -> np.ndarray:
    """What is counted of each line of a document: one row of ``STATS`` numbers a line."""
    out, seen = np.zeros((len(lines), STATS)), set()
    for row, line in zip(out, lines):
        data = line.encode("utf-8", "surrogatepass")
        size, words = len(data), line.split()
        n = len(words)
        letters = size - len(data.translate(None, UPPER + LOWER + HIGH))
        upper = size - len(data.translate(None, UPPER))
        stops = size - len(data.translate(None, STOPS))
        other = len(data.translate(None, UPPER + LOWER + HIGH + DIGITS + STOPS + BLANKS))
        row[:] = (log(size), upper / max(1, letters), (size - len(data.translate(None, DIGITS))) / size, stops / size, other / size,
                  letters / size, 1 - len(set(words)) / n, sum(map(eq, words, words[1:])) / n, size / n, data.count(b"!") / n,
                  (size - len(data.translate(None, HIGH))) / size, line in seen)
        seen.add(line)
    return out


def binned(stats: np.ndarray) -> np.ndarray:
    """Feature numbers of each line: the bin of each number, counted through."""
    return np.stack([np.searchsorted(EDGES[i], stats[:, i], "left") + BINS * i for i in range(STATS)], axis=1)


def line_scores(features: np.ndarray, first: np.ndarray, last: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How much a line by itself and its neighbours speak for good; ``first`` and ``last`` mark ends of documents.

    ``weights`` has a row for the line, for the one before and for the one
    after, each with a last place for where there is none.
    """
    own, before, after = weights[:, :-1]
    score = own[features].sum(axis=1) + weights[0, -1]
    score[~first] += before[features].sum(axis=1)[np.flatnonzero(~first) - 1]
    score[~last] += after[features].sum(axis=1)[np.flatnonzero(~last) + 1]
    return score + np.where(first, weights[1, -1], 0) + np.where(last, weights[2, -1], 0)


def good_marginals(scores: list[float], turns: list[float]) -> list[float]:
    """Forward-backward over one document: the probability of good of each line.

    ``turns`` are the factors bad-bad, bad-good, good-bad and good-good.  Both
    passes keep the ratio of good to bad, which stays within the factors.
    """
    bb, bg, gb, gg = turns
    odds = [exp(min(30.0, max(-30.0, s))) for s in scores]
    forward, a = [], 0.0
    for i, o in enumerate(odds):
        a = o * (a * gg + bg) / (a * gb + bb) if i else o
        forward.append(a)
    out, b = [0.0] * len(odds), 1.0
    for i in range(len(odds) - 1, -1, -1):
        r = forward[i] * b
        out[i] = r / (1 + r)
        o = odds[i] * b
        b = (o * gg + gb) / (o * bg + bb)
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    turns: list[float]
    slope: float  # of the logarithm of the bad share
    shift: float
    base: float  # share of label 1, for texts without a line

    def values(self) -> tuple:
        return self.weights, self.turns, self.slope, self.shift, self.base


def bad_share(texts: list[str | None], weights: np.ndarray, turns: list[float]) -> list[float | None]:
    """Length-weighted mean probability of bad over the lines of each text; None without a line."""
    lines = [lines_of(t) for t in texts]
    counts = [len(x) for x in lines]
    stats = np.concatenate([line_stats(x) for x in lines] or [np.zeros((0, STATS))])
    ends = np.cumsum(counts, dtype=np.int64)
    first, last = np.zeros(len(stats), bool), np.zeros(len(stats), bool)
    full = np.flatnonzero(counts)
    first[(ends - counts)[full]], last[ends[full] - 1] = True, True
    scores = line_scores(binned(stats), first, last, weights).tolist()
    out: list[float | None] = [None] * len(texts)
    for i in full:
        good = good_marginals(scores[ends[i] - counts[i]:ends[i]], turns)
        sizes = [len(x) for x in lines[i]]
        out[i] = 1 - sum(g * s for g, s in zip(good, sizes)) / sum(sizes)
    return out


def _stable_sigmoid(x: float) -> float:
    return 1 / (1 + exp(-x)) if x >= 0 else exp(x) / (1 + exp(x))


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, stats of the lines as bytes)."""
    for batch in batches:
        stats = [line_stats(lines_of(t)) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.tobytes() for s in stats], pa.binary())],
                                         ["id", "label", "stats"])


def fit_chain(stats: list[np.ndarray], labels: np.ndarray, *, rounds: int = 200, rate: float = 0.08, decay: float = 1e-3):
    """Weights and turns of the field, by gradient steps (Adam) on the likelihood of the document labels.

    Only documents are labelled: label 1 says that all lines are good, label 0
    that at least one is bad.  Each class weighs half.
    """
    counts = np.array([len(s) for s in stats])
    rows = np.concatenate(stats)
    features, starts = binned(rows), np.cumsum(counts) - counts
    first, last = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    first[starts], last[starts + counts - 1] = True, True
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    order = np.argsort(-counts, kind="stable")
    deep = counts[order]
    steps = [(k, starts[order[:np.searchsorted(-deep, -k, "left")]] + k) for k in range(deep[0])]  # lines k of documents that have one
    weights, turns = np.zeros((3, STATS * BINS + 1)), np.zeros((2, 2))  # turns[from, to], bad 0 and good 1
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, turns)]
    doc = np.repeat(np.arange(len(counts)), counts)
    for t in range(1, rounds + 1):
        score = line_scores(features, first, last, weights)
        node = np.stack([np.zeros(len(rows)), score], axis=1)
        ahead = np.zeros((len(rows), 2))
        for k, at in steps:
            ahead[at] = node[at] if k == 0 else node[at] + np.logaddexp.reduce(ahead[at - 1][:, :, None] + turns, axis=1)
        behind = np.zeros((len(rows), 2))
        for k, at in reversed(steps[1:]):
            behind[at - 1] = np.logaddexp.reduce(turns + (node[at] + behind[at])[:, None, :], axis=2)
        total = np.logaddexp.reduce(ahead[starts + counts - 1], axis=1)
        marginal = np.exp(ahead + behind - total[doc][:, None])[:, 1]
        whole = np.bincount(doc, score, len(counts)) + (counts - 1) * turns[1, 1] - total  # log P(all good)
        odds = np.exp(np.minimum(whole, -1e-9)) / -np.expm1(np.minimum(whole, -1e-9))
        pull = share * np.where(labels == 1, 1.0, -odds)
        gap = pull[doc] * (1 - marginal)
        grown = np.zeros_like(weights)
        for side, rows_of, lines in ((0, features, gap), (1, features[np.flatnonzero(~first) - 1], gap[~first]),
                                     (2, features[np.flatnonzero(~last) + 1], gap[~last])):
            grown[side, :-1] = np.bincount(rows_of.ravel(), np.repeat(lines, STATS), STATS * BINS)
        grown[0, -1], grown[1, -1], grown[2, -1] = gap.sum(), gap[first].sum(), gap[last].sum()
        inner = np.flatnonzero(~first)
        pairs = np.exp(ahead[inner - 1][:, :, None] + turns + (node[inner] + behind[inner])[:, None, :] - total[doc[inner]][:, None, None])
        moved = -(pull[doc[inner]][:, None, None] * pairs).sum(axis=0)
        moved[1, 1] += (pull * (counts - 1)).sum()
        for value, (m, v), step in ((weights, moments[0], grown - decay * weights), (turns, moments[1], moved - decay * turns)):
            m += 0.1 * (step - m)
            v += 0.01 * (step * step - v)
            value += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return weights, np.exp(turns).ravel().tolist()


def calibrate(x: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve of ``x``, by Newton steps with a small ridge."""
    design, w = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        pull = design.T @ (labels - p) - 1e-2 * w
        w += np.linalg.solve((design * (p * (1 - p) + 1e-6)[:, None]).T @ design + 1e-2 * np.eye(2), pull)
    return float(w[0]), float(w[1])


def _tail(share: np.ndarray | float):
    """The calibrated scale of a bad share."""
    return np.log(np.asarray(share) + 1e-3)


def fit_quality(docs: DataFrame, labels: DataFrame, *, most: int = 4000, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", fold: int = 1, folds: int = 3) -> QualityModel:
    """Learn from labelled rows outside the held-out fold, at most ``most`` of each label.

    Only numbers about the lines of these examples reach the driver; one with
    more than ``MOST_LINES`` lines isn't taken as an example.  Repeated labels
    of an id count once (the greatest); null labels and ids are left out.  With
    a single class, or none, every text gets the share of label 1 (or a half).
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(fold_of(id_col, folds) != fold)
             .groupBy(id_col).agg((F.max(F.col(label_col).cast("int")) >= 1).cast("int").alias("label")))
    held = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = held.get(1, 0) / sum(held.values()) if held else 0.5
    few = thinned(known, "label", most, [id_col]).select(F.col(id_col).alias("id"), "label")
    lines = F.size(F.split(F.col(text_col), "\n"))
    rows = (docs.where(lines <= MOST_LINES).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(few), "id")
            .select(F.col("id").cast("bigint"), "label", "text"))
    found = bound_batches(rows).mapInArrow(_example_rows, "id bigint, label int, stats binary").toArrow()
    found = sorted({(i, y, s) for i, y, s in zip(*(c.to_pylist() for c in found.columns)) if s})
    labels_ = np.array([y for _, y, _ in found])
    if len(set(labels_.tolist())) < 2:
        return QualityModel(np.zeros((3, STATS * BINS + 1)), [1.0] * 4, 0.0, log((base + 1e-6) / (1 - base + 1e-6)), base)
    stats = [np.frombuffer(s).reshape(-1, STATS) for *_, s in found]
    weights, turns = fit_chain(stats, labels_)
    shares = []
    for s in stats:
        at = np.arange(len(s))
        score = line_scores(binned(s), at == 0, at == len(s) - 1, weights)
        size = np.exp(s[:, 0])
        shares.append(1 - float(np.dot(good_marginals(score.tolist(), turns), size) / size.sum()))
    slope, shift = calibrate(_tail(np.array(shares)), labels_)
    # the examples may hold the classes in other shares than the labels
    taken = labels_.mean()
    return QualityModel(weights, turns, slope, shift + log(base / (1 - base)) - log(taken / (1 - taken)), base)


def score_quality(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text", fold: int = 1,
                  folds: int = 3) -> DataFrame:
    """(id, held_out, score, predicted, bad_share) of every whole text.

    Texts without a line (null, empty, blank) get the share of label 1 among
    the labels and a null bad share.  Repeated rows score alike; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.values())
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, turns, slope, shift, base = shared.value
        for batch in batches:
            bad = bad_share(batch.column(2).to_pylist(), weights, turns)
            score = [base if b is None else _stable_sigmoid(slope * float(_tail(b)) + shift) for b in bad]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()),
                 pa.array(bad, pa.float64())], ["id", "held_out", "score", "predicted", "bad_share"])

    return (bound_batches(docs).select(F.col(id_col).alias("id"), (fold_of(id_col, folds) == fold).alias("held_out"), text_col)
            .mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int, bad_share double").withColumnRenamed("id", id_col))
