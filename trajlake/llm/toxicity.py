"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted lists."""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from trajlake.llm.common import bound_batches, stored
from trajlake.llm.language import fold_of, thinned

BLOCK = 256  # examples of one block of the inverted lists
OFTEN = 32  # examples of a block with a term, from which on the term is kept inside the block
FIRST = 1  # blocks of a text that are opened whatever their bounds
RUN = 32  # places, far from each other, whose greatest cosine stands for them
COMMON, GROUPS, ROUNDS = 512, 64, 5  # frequent terms, groups and rounds of the order of the examples
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„’‘¡¿…"
STEMS = (5,)  # lengths of the word beginnings that are terms of their own
MEMO = 100_000
WORDS = 1 << 20  # terms a task remembers
PIECE = 1 << 17  # characters looked at together
BASE, SPREAD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9  # odd, so that powers have inverses
BATCH = 256  # texts searched at once
SLACK = 1e-4  # more than the rounding of approximate cosines


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def terms_of(word: str) -> list[str]:
    """The terms a word stands for: itself and its beginnings."""
    word = word.strip(EDGES)
    return [word, *[f"{word[:n]}-" for n in STEMS if len(word) >= n]] if word else []


def _hashes(terms: list[str]) -> np.ndarray:
    try:
        return np.fromiter(map(xxh3_64_intdigest, terms), np.uint64, len(terms))
    except UnicodeEncodeError:  # half a surrogate pair
        return np.fromiter((xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in terms), np.uint64, len(terms))


def term_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of ``terms_of`` the words, one after the other, and how many each word has."""
    bare = [w.strip(EDGES) for w in words]
    length = np.fromiter(map(len, bare), np.int64, len(bare))
    lists = [(length > 0, [w for w in bare if w]), *[(length >= n, [w[:n] + "-" for w in bare if len(w) >= n]) for n in STEMS]]
    sizes = sum(has.astype(np.int64) for has, _ in lists)
    place = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), np.uint64)
    for has, terms in lists:
        flat[place[has]] = _hashes(terms)
        place += has
    return flat.view(np.int64), sizes


def _pieces(texts: list[str | None]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Lower-case texts joined by spaces, where each starts and which it is; long ones are cut between words."""
    some, starts, owners, size = [], [], [], 0
    for i, text in enumerate(texts):
        text, a = (text or "").lower(), 0
        while a < len(text):
            b = a + PIECE
            while b < len(text) and not text[b].isspace():
                b += 1
            some.append(text[a:b])
            starts.append(size)
            owners.append(i)
            size, a = size + len(some[-1]) + 1, b
            if size > PIECE:
                yield " ".join(some), np.array(starts), np.array(owners)
                some, starts, owners, size = [], [], [], 0
    if some:
        yield " ".join(some), np.array(starts), np.array(owners)


class TermNumbers:
    """Numbers of all terms in a text, without a Python object for each word.

    A term is known by a 64-bit polynomial of its code points: a stretch's comes
    from two running sums.  Terms of the last keys seen are remembered, one a
    place; ``look_up`` numbers the names of others (-1: none).
    """

    def __init__(self, look_up):
        self.look_up = look_up
        self.kind = np.zeros(0x3002, np.uint8)  # of a code point: 1 space, 2 edge; the last stands for all others
        self.kind[[c for c in range(0x3001) if chr(c).isspace()]] = 1
        self.kind[[ord(c) for c in EDGES]] = 2
        self.power = self.inverse = np.ones(1, np.uint64)
        self.key, self.number = np.zeros(WORDS, np.uint64), np.full(WORDS, -1, np.int32)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            both = np.array([[BASE], [pow(BASE, -1, 1 << 64)]], np.uint64).repeat(n, axis=1)
            both[:, 0] = 1
            self.power, self.inverse = np.multiply.accumulate(both, axis=1)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where the word of each term begins, and the term's number; words as ``terms_of`` splits and strips them."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kind[np.minimum(code, 0x3001)]
        turn = np.flatnonzero(np.diff(kind == 1, prepend=True, append=True))
        inner = np.flatnonzero(kind == 0)
        before = np.concatenate([[0], np.cumsum(kind == 0, dtype=np.int32)])
        a, b = before[turn[::2]], before[turn[1::2]]
        a, b = a[a < b], b[a < b]
        begin, end = inner[a], inner[b - 1] + 1
        self._powers(max(len(code), *STEMS) + 1)
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code + np.uint32(1)) * self.power[:len(code)], out=total[1:])
        keys, begins, ends = [(total[end] - total[begin]) * self.inverse[begin]], [begin], [end]
        for n in STEMS:
            at = begin[end - begin >= n]
            keys.append((total[at + n] - total[at]) * self.inverse[at] + self.power[n:n + 1] * np.uint64(ord("-") + 1))
            begins.append(at)
            ends.append(at + n)
        key, begins, ends = np.concatenate(keys), np.concatenate(begins), np.concatenate(ends)
        place = ((key * np.uint64(SPREAD) >> np.uint64(32)) * np.uint64(len(self.key)) >> np.uint64(32)).astype(np.int64)
        number = self.number[place]
        new = np.flatnonzero(self.key[place] != key)
        if len(new):
            _, one, same = np.unique(key[new], return_index=True, return_inverse=True)
            one = new[one]
            tails = np.where(one < len(begin), "", "-").tolist()
            names = [text[a:b] + tail for a, b, tail in zip(begins[one].tolist(), ends[one].tolist(), tails)]
            number[new] = self.look_up(names)[same]
            self.key[place[new]], self.number[place[new]] = key[new], number[new]
        return begins, number


@dataclass
class TermCounts:
    """The terms (ascending) and counts of the examples, one after the other, and how many each has."""

    size: np.ndarray
    term: np.ndarray
    n: np.ndarray


def _pack(at: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending terms and counts of one example in few bytes."""
    return tuple(zlib.compress(x.astype(np.int32).tobytes(), 1) for x in (np.diff(at, prepend=0), n))


@dataclass
class PackedCounts:
    """``TermCounts`` as the tasks packed it, an example at a time; only who searches unpacks it."""

    term: list[bytes]
    n: list[bytes]

    def unpacked(self) -> TermCounts:
        terms = [np.cumsum(np.frombuffer(zlib.decompress(t), np.int32), dtype=np.int32) for t in self.term]
        n = [np.frombuffer(zlib.decompress(x), np.int32) for x in self.n]
        none = np.zeros(0, np.int32)
        return TermCounts(np.array([len(t) for t in terms], np.int32), np.concatenate([none, *terms]), np.concatenate([none, *n]))


class TermIndex:
    """Inverted lists of weighted examples; what fills a block of alike examples is kept in the block, with its greatest weight.

    An entry is in one place only: in its block if at least ``OFTEN`` examples
    of the block have its term, else in the list of the term.  Approximate
    cosines are single precision; ``exact`` adds up an example's own weights in
    double precision.
    """

    def __init__(self, size: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int):
        self.examples = len(size)
        self.own = np.concatenate([[0], np.cumsum(size)])
        self.term, self.weight = term.astype(np.int32, copy=False), weight
        self.label = self._alike(size, self.term, weight, terms)
        self.blocks = -(-len(size) // BLOCK)
        inside, self.long, left, row = [], [], [], np.full(terms, -1, np.int32)
        for b in range(self.blocks):
            members = self.label[b * BLOCK:(b + 1) * BLOCK]
            t, w = self._of(members)
            w, place = w.astype(np.float32), np.repeat(np.arange(len(members), dtype=np.int32), size[members])
            inside.append(np.flatnonzero(np.bincount(t, minlength=terms) >= OFTEN))
            row[inside[-1]] = np.arange(len(inside[-1]))
            hit = row[t] >= 0
            self.long.append(np.zeros((len(inside[-1]), BLOCK), np.float32))
            self.long[-1][row[t[hit]], place[hit]] = w[hit]
            row[inside[-1]] = -1
            left.append((t[~hit], place[~hit] + np.int32(b * BLOCK), w[~hit]))
        long = np.unique(np.concatenate([np.zeros(0, np.int64), *inside]))
        self.long_of = np.full(terms, -1, np.int32)
        self.long_of[long] = np.arange(len(long))
        self.inside = [self.long_of[x] for x in inside]  # the long terms of each block
        self.block_max = np.zeros((len(long), self.blocks), np.float32)
        for b, at in enumerate(self.inside):
            self.block_max[at, b] = self.long[b].max(axis=1, initial=0)
        t = np.concatenate([np.zeros(0, np.int32), *[x for x, _, _ in left]])
        self.start = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=terms))])
        order = np.argsort(t, kind="stable")
        self.entry = np.empty(len(t), np.int64)  # place and weight, as both are needed at once
        if len(t):
            self.entry.view(np.int32)[::2] = np.concatenate([x for _, x, _ in left])[order]
            self.entry.view(np.float32)[1::2] = np.concatenate([x for _, _, x in left])[order]
        self.query = np.zeros(terms)

    def _of(self, examples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of the examples, one after the other."""
        spans = list(zip(self.own[examples].tolist(), self.own[examples + 1].tolist()))
        return np.concatenate([self.term[a:b] for a, b in spans]), np.concatenate([self.weight[a:b] for a, b in spans])

    @staticmethod
    def _alike(size: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int) -> np.ndarray:
        """The examples in an order that brings alike ones together, by k-means over the frequent terms, so that blocks share terms."""
        examples = len(size)
        frequent = np.full(terms, -1, np.int32)
        common = np.argsort(-np.bincount(term, minlength=terms), kind="stable")[:COMMON]
        frequent[common] = np.arange(len(common))
        some = np.flatnonzero(frequent[term] >= 0)
        x = np.zeros((examples, len(common)), np.float32)
        x[np.repeat(np.arange(examples, dtype=np.int32), size)[some], frequent[term[some]]] = weight[some]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        groups = max(1, min(GROUPS, examples // BLOCK))
        if not examples or groups == 1:
            return np.arange(examples)
        middle = x[np.linspace(0, examples - 1, groups).astype(int)]
        for _ in range(ROUNDS):
            near = np.argmax(x @ middle.T, axis=1)
            member = np.zeros((groups, examples), np.float32)
            member[near, np.arange(examples)] = 1
            middle = member @ x
            middle /= np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-9)
        like, chain_of = middle @ middle.T, [0]  # each group beside the most alike one that is left
        while len(chain_of) < groups:
            like[:, chain_of[-1]] = -1
            chain_of.append(int(np.argmax(like[chain_of[-1]])))
        position = np.empty(groups, int)
        position[chain_of] = np.arange(groups)
        return np.argsort(position[near], kind="stable")

    @classmethod
    def of_dense(cls, weights: np.ndarray) -> TermIndex:
        example, term = np.nonzero(weights.T)
        return cls(np.bincount(example, minlength=weights.shape[1]), term, weights[term, example], len(weights))

    @classmethod
    def of_counts(cls, counts: TermCounts, idf: np.ndarray) -> TermIndex:
        example = np.repeat(np.arange(len(counts.size), dtype=np.int32), counts.size)
        w = np.log(counts.n)
        w += 1
        w *= idf[counts.term]
        w /= np.sqrt(np.bincount(example, weights=w * w))[example]
        return cls(counts.size, counts.term, w, len(idf))

    def exact(self, at: np.ndarray, w: np.ndarray, examples: np.ndarray) -> np.ndarray:
        self.query[at] = w
        term, weight = self._of(examples)
        near = self.query[term] * weight
        self.query[at] = 0
        size = self.own[examples + 1] - self.own[examples]
        return np.add.reduceat(near, np.cumsum(size) - size)

    def _open(self, cosine: np.ndarray, far: np.ndarray, wanted: np.ndarray) -> None:
        """Add what is kept inside the wanted blocks."""
        for b, inside in enumerate(self.inside):
            rows = np.flatnonzero(wanted[:, b])
            if len(rows) and len(inside):
                cosine[rows, b * BLOCK:(b + 1) * BLOCK] += far[rows[:, None], inside] @ self.long[b]

    @staticmethod
    def _least(cosine: np.ndarray, k: int) -> np.ndarray:
        """What the k-th greatest of each row is at least: the k-th greatest of the greatest ones of ``RUN`` places each."""
        best = cosine.reshape(len(cosine), RUN, -1).max(axis=1)
        if best.shape[1] < k:
            return np.zeros(len(cosine), np.float32)
        return np.partition(best, -k, axis=1)[:, -k]

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """The ``k`` examples of the greatest cosine above 0 of each query, exactly; ties go to the earlier example.

        Lists are added up whole.  That sum bounds a cosine from below; with the
        greatest weights inside a block it bounds it from above.  The ``FIRST``
        blocks of the greatest bounds are opened first, then only those that can
        still reach the k-th lower bound.  What comes within ``SLACK`` of the
        k-th is computed again exactly.
        """
        if not self.examples:
            return [[] for _ in queries]
        k = min(k, self.examples)
        cosine = np.zeros((len(queries), self.blocks * BLOCK), np.float32)
        far = np.zeros((len(queries), len(self.block_max)), np.float32)
        for row, wide, (at, w) in zip(cosine, far, queries):
            place = self.long_of[at]
            wide[place[place >= 0]] = w[place >= 0]
            start = self.start[at]
            size = self.start[at + 1] - start
            ends = np.cumsum(size)
            pick = np.repeat(start - ends + size, size)
            pick += np.arange(len(pick))
            entry = self.entry[pick]
            row += np.bincount(entry.view(np.int32)[::2], entry.view(np.float32)[1::2] * np.repeat(w, size), len(row)).astype(np.float32)
        bound = far @ self.block_max + cosine.reshape(len(queries), self.blocks, BLOCK).max(axis=2)
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, np.argpartition(-bound, min(FIRST, self.blocks) - 1, axis=1)[:, :FIRST], True, axis=1)
        self._open(cosine, far, first)
        self._open(cosine, far, ~first & (bound >= self._least(cosine, k)[:, None] - SLACK))
        least = self._least(cosine, k)
        out = []
        for row, floor, (at, w) in zip(cosine, least, queries):
            near = np.flatnonzero(row[:self.examples] >= max(floor - SLACK, SLACK))
            if len(near) > k:
                near = near[row[near] >= np.partition(row[near], -k)[-k] - SLACK]
            if len(near) < k:  # fewer than k examples share a term that counts
                near = np.flatnonzero(row[:self.examples] > 0)
            if not len(near):
                out.append([])
                continue
            near = self.label[near]
            found = sorted((-round(c, 12), i) for c, i in zip(self.exact(at, w, near).tolist(), near.tolist()) if c > 0)
            out.append([(-c, i) for c, i in found[:k]])
        return out


@dataclass
class ToxicityModel:
    """Examples as weighted terms; terms by name, or the ascending hashes of all terms."""

    terms: dict[str, int] | np.ndarray
    idf: np.ndarray  # weight of each term
    ids: list[int]
    toxic: np.ndarray
    worth: np.ndarray  # documents an example stands for
    weights: np.ndarray | TermCounts | PackedCounts  # terms x examples
    base: float  # share of toxic documents among those without any term
    k: int = 9
    smooth: float = 0.05
    numbers: TermNumbers | None = field(default=None, repr=False, compare=False)
    found: dict = field(default_factory=dict, repr=False, compare=False)
    index: TermIndex | None = field(default=None, repr=False, compare=False)

    def prepare(self):
        """Make the lists and blocks, where the first text is searched."""
        if isinstance(self.weights, (TermCounts, PackedCounts)):
            counts = self.weights.unpacked() if isinstance(self.weights, PackedCounts) else self.weights
            self.index = TermIndex.of_counts(counts, self.idf)
        else:
            self.index = TermIndex.of_dense(np.asarray(self.weights))

    @property
    def block_max(self) -> np.ndarray:
        return self.index.block_max

    @classmethod
    def without_examples(cls, terms: np.ndarray, idf: np.ndarray | None = None, base: float = 0.0, k: int = 9) -> ToxicityModel:
        idf = np.ones(len(terms)) if idf is None else idf
        return cls(terms, idf, [], np.zeros(0), np.zeros(0), PackedCounts([], []), base, k)

    def values(self) -> tuple:
        """What a worker needs, as plain values: it builds its own model of them."""
        w = self.weights
        return (np.asarray(self.terms).tobytes(), zlib.compress(self.idf.tobytes(), 1), self.ids, self.toxic, self.worth, w.term, w.n, self.base, self.k, self.smooth)

    @classmethod
    def of_values(cls, values: tuple) -> ToxicityModel:
        terms, idf, ids, toxic, worth, term, n, base, k, smooth = values
        return cls(np.frombuffer(terms, np.int64), np.frombuffer(zlib.decompress(idf)), ids, toxic, worth, PackedCounts(term, n), base, k, smooth)

    def look_up(self, names: list[str]) -> np.ndarray:
        """The numbers of terms, -1 for those the model does not have."""
        if isinstance(self.terms, dict):
            return np.fromiter((self.terms.get(t, -1) for t in names), np.int32, len(names))
        if not len(self.terms):
            return np.full(len(names), -1, np.int32)
        hashes = _hashes(names).view(np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1).astype(np.int32)

    def _keys(self, texts: list[str | None]) -> np.ndarray:
        """(text, term) as one number for each occurrence of a term of the model, ascending."""
        if self.numbers is None:
            self.numbers = TermNumbers(self.look_up)
        keys = [np.zeros(0, np.int64)]
        for text, starts, owners in _pieces(texts):
            begin, number = self.numbers.of(text)
            begin, number = begin[number >= 0], number[number >= 0]
            keys.append(owners[np.searchsorted(starts, begin, "right") - 1] * max(1, len(self.terms)) + number)
        return np.sort(np.concatenate(keys))

    def terms_once(self, texts: list[str | None]) -> np.ndarray:
        """The model's terms in the whole texts, each once a text."""
        key = self._keys(texts)
        return key[np.diff(key, prepend=-1) > 0] % max(1, len(self.terms))

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The model's terms in each whole text, ascending, and their counts; all texts are looked up and sorted together."""
        key, width = self._keys(texts), max(1, len(self.terms))
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.diff(first, append=len(key)).astype(np.float64)
        key = key[first]
        ends = np.searchsorted(key, np.arange(len(texts) + 1) * width)
        term = key % width
        return [(term[a:b], n[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.vectors([text])[0]

    def unit(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (1 + np.log(n)) * self.idf[at]
        return w / np.linalg.norm(w)

    def weigh(self, vector: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
        at = np.array([t for t, _ in vector], int)
        return at, self.unit(at, np.array([n for _, n in vector], float))

    def nearest(self, vector: tuple[tuple[int, int], ...]) -> list[tuple[float, int]]:
        return self.search([self.weigh(vector)])[0]

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> list[list[tuple[float, int]]]:
        if self.index is None:
            self.prepare()
        return self.index.search(queries, self.k)

    def vote(self, near: list[tuple[float, int]]) -> tuple[float, list[int]]:
        """Votes count by cosine and by how many documents an example stands for; the base share is the prior."""
        if not near:
            return self.base, []
        vote = np.array([c * self.worth[i] for c, i in near])
        own, total = float(vote @ self.toxic[[i for _, i in near]]), float(vote.sum())
        smooth = self.smooth * total / len(near)
        score = (own + smooth * self.base) / (total + smooth) if total + smooth > 0 else self.base
        return min(1.0, max(0.0, score)), [self.ids[i] for _, i in near[:3]]

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[int]]]:
        """Probability of label 1 and the ids of the nearest examples, of each text."""
        keys = [blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
        if len(self.found) > MEMO:
            self.found.clear()
        new = {key: t for key, t in zip(keys, texts) if key not in self.found}
        fresh = list(new)
        for i in range(0, len(fresh), BATCH):
            queries = []
            for key, (at, n) in zip(fresh[i:i + BATCH], self.vectors([new[key] for key in fresh[i:i + BATCH]])):
                if len(at):
                    queries.append((key, (at, self.unit(at, n))))
                else:
                    self.found[key] = self.base, []
            for (key, _), near in zip(queries, self.search([q for _, q in queries]) if queries else []):
                self.found[key] = self.vote(near)
        return [self.found[key] for key in keys]


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic) for every term of every example, terms as hashes."""
    for batch in batches:
        for y, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = set(words_of(text))
            terms = np.unique(term_hashes(list(words))[0])
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array([y] * len(terms), pa.int32())], ["term", "toxic"])


def term_contrast(examples: DataFrame, n: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all terms of the examples, ascending, and by how many standard errors their shares of the two classes differ."""
    a, b = F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    counts = examples.mapInArrow(_term_rows, "term bigint, toxic int").groupBy("term").agg(a, b).toArrow().sort_by("term")
    a, b = counts["a"].to_numpy().astype(float), counts["b"].to_numpy().astype(float)
    if set(n) < {0, 1}:
        return counts["term"].to_numpy(), np.zeros(len(a))
    both = (a + b + 0.5) / (n[0] + n[1] + 1)
    return counts["term"].to_numpy(), np.abs(a / n[1] - b / n[0]) / np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))


def _of_terms(shared: Broadcast) -> ToxicityModel:
    """The model without examples that a worker keeps for all its tasks."""
    if shared.value[1] is None:
        shared.value[1] = ToxicityModel.without_examples(np.frombuffer(shared.value[0], np.int64))
    return shared.value[1]


def _vector_rows(shared: Broadcast):
    """(id, toxic, term numbers, counts) of every example, the last two packed; empty if it has no term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _of_terms(shared)
        for batch in batches:
            found = [_pack(at, n) if len(at) else (b"", b"") for at, n in model.vectors(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([at for at, _ in found], pa.binary()),
                                              pa.array([n for _, n in found], pa.binary())], ["id", "toxic", "at", "n"])
    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, most_toxic: int = 2000, most_clean: int = 10_000, k: int = 9,
                 id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Examples from the labelled rows outside the held-out fold.

    At most ``most_toxic`` examples of label 1 and ``most_clean`` of label 0 are
    kept, each with all its terms; their counts reach the driver.  A term weighs
    its inverse document frequency over all documents times one plus
    ``term_contrast``: no term is left out, and those that tell the classes
    apart decide which examples are near.  Terms of a text that no example has
    would scale all its cosines alike, which changes neither order nor score.
    An example stands for its share of the labelled rows of its class.
    Repeated labels of an id count once (the greatest); null labels and ids are
    left out.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(fold_of(id_col) != 0)
             .groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("toxic")))
    held = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = (thinned(known.where("toxic = 1"), "toxic", most_toxic, [id_col])
           .unionByName(thinned(known.where("toxic <> 1"), "toxic", most_clean, [id_col])).select(F.col(id_col).alias("id"), "toxic"))
    examples = stored(docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
                      .join(F.broadcast(ids), "id").select(F.col("id").cast("bigint"), "toxic", "text"))
    taken = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    worths = {y: held[y] / n for y, n in taken.items()}
    names, contrast = term_contrast(examples, taken)
    shared = docs.sparkSession.sparkContext.broadcast([names.tobytes(), None])
    n_docs, df = document_counts(docs, shared, len(names), text_col)
    idf = (np.log((1 + n_docs) / (1 + df)) + 1) * (1 + contrast)
    rows = (bound_batches(examples).mapInArrow(_vector_rows(shared), "id bigint, toxic int, at binary, n binary")
            .toArrow().sort_by([("id", "ascending"), ("toxic", "ascending"), ("at", "ascending"), ("n", "ascending")]))
    kept, packed, empty = [], PackedCounts([], []), Counter()
    for i, y, at, n in zip(*(rows[c].to_pylist() for c in ("id", "toxic", "at", "n"))):
        if not at:
            empty[y] += worths[y]
            continue
        kept.append((i, y, worths[y]))
        packed.term.append(at)
        packed.n.append(n)
    shared.unpersist()
    del rows, contrast, df
    pa.default_memory_pool().release_unused()  # the driver keeps the model only
    share = empty[1] / sum(empty.values()) if empty else held.get(1, 0) / max(1, sum(held.values()))
    if not kept:
        return ToxicityModel.without_examples(names, idf, share, k)
    return ToxicityModel(names, idf, [i for i, _, _ in kept], np.array([y for _, y, _ in kept], float),
                         np.array([w for _, _, w in kept]), packed, share, k)


def document_counts(docs: DataFrame, shared: Broadcast, terms: int, text_col: str = "text") -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each of the shared terms occurs; a task sends each term it saw once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _of_terms(shared)
        total, n = np.zeros(terms, np.int64), 0
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                some = batch.column(0).slice(i, BATCH).to_pylist()
                n += len(some)
                np.add.at(total, model.terms_once(some), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], some])), pa.array(np.concatenate([[n], total[some]]))], ["term", "n"])

    counts = (bound_batches(docs).select(text_col).mapInArrow(run, "term bigint, n bigint")
              .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    df = np.zeros(terms + 1)
    df[counts["term"].to_numpy()] = counts["n"].to_numpy()  # -1 is the last
    return int(df[-1]), df[:-1]


def toxicity_of(model: ToxicityModel, docs: DataFrame, text: Column) -> Column:
    """struct(score, evidence): the score of a text and the ids of its nearest examples."""
    # the second place holds what a worker builds of the first, for all its tasks
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast([model.values(), None])

    @F.pandas_udf("struct<score: double, evidence: array<bigint>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        if shared.value[1] is None:
            shared.value[1] = ToxicityModel.of_values(shared.value[0])
        scored = shared.value[1].scores(list(texts))
        return pd.DataFrame({"score": [s for s, _ in scored], "evidence": [e for _, e in scored]})

    return run(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted, evidence) of every whole text.

    Every text with a term of any example is voted on by its neighbours of both
    labels; others, null and empty ones among them, get the share of toxic
    documents among empty examples, or else among all labels.  Repeated rows score
    alike; an empty table gives an empty result.
    """
    scored = docs.select(id_col, (fold_of(id_col) == 0).alias("held_out"), toxicity_of(model, docs, F.col(text_col)).alias("_out"))
    return scored.select(id_col, "held_out", F.col("_out.score").alias("score"),
                         F.when(F.col("_out.score") >= 0.5, 1).otherwise(0).alias("predicted"), F.col("_out.evidence").alias("evidence"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below a half, all columns."""
    return docs.where(toxicity_of(model, docs, F.col(text_col))["score"] < 0.5)
