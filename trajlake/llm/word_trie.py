"""Counting phrases of word ids: hash containers under a shallow trie that burst when full and leave as sorted runs."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BITS = 21  # of a word id; three fit into a key
MIX = np.uint64(0x9E3779B97F4A7C15)


class Container:
    """An open-addressing hash table of keys and counts, for the keys from ``low`` on up to the next container."""

    def __init__(self, low: int, slots: int = 1024):
        self.low, self.used = low, 0
        self.keys, self.n = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        """Add counts of distinct keys."""
        slots = len(self.keys)
        while (self.used + len(keys)) * 2 > slots:
            slots *= 2
        if slots > len(self.keys):
            held, counts = self.items()
            self.keys, self.n, self.used = np.full(slots, -1, np.int64), np.zeros(slots, np.int64), 0
            self.add(held, counts)
        at = ((keys.astype(np.uint64) * MIX) >> np.uint64(64 - slots.bit_length() + 1)).astype(np.int64)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for a free slot one gets it
            hit = self.keys[at] == keys
            self.n[at[hit]] += n[hit]
            self.used += int((free & hit).sum())
            keys, n, at = keys[~hit], n[~hit], (at[~hit] + 1) & (slots - 1)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        held = np.flatnonzero(self.keys >= 0)
        return self.keys[held], self.n[held]


class WordTrie:
    """Counts of phrases of ``width`` word ids, each below 2 ** ``BITS``.

    A container holds the phrases of a range of first words.  One with more
    than ``burst`` of them is split between two words; when a single word fills
    it, between two second words below that one, and so on: the trie is as deep
    as the frequent prefixes need.  With more than ``most`` phrases together,
    the largest subtrees are taken out as sorted runs until half are left.
    """

    def __init__(self, width: int, *, burst: int = 1 << 16, most: int = 1 << 21):
        self.width, self.burst, self.most = width, burst, most
        self.parts, self.lows = [Container(0)], np.zeros(1, np.int64)

    def __len__(self) -> int:
        return sum(p.used for p in self.parts)

    def key(self, words: list[np.ndarray]) -> np.ndarray:
        out = words[0]
        for w in words[1:]:
            out = out << BITS | w
        return out

    def words(self, keys: np.ndarray) -> list[np.ndarray]:
        return [keys >> (BITS * i) & ((1 << BITS) - 1) for i in range(self.width - 1, -1, -1)]

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Count keys (repeated ones too); yields the runs (keys ascending, counts) that have to leave."""
        keys, n = np.unique(keys, return_counts=True)
        cuts = np.searchsorted(keys, self.lows[1:])
        for part, some, counts in zip(list(self.parts), np.split(keys, cuts), np.split(n, cuts)):
            if len(some):
                part.add(some, counts)
                self._burst(part)
        self.lows = np.array([p.low for p in self.parts])
        if len(self) > self.most:
            yield from self.spill(self.most // 2)

    def _burst(self, part: Container) -> None:
        if part.used <= self.burst:
            return
        keys, n = part.items()
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        middle = int(keys[len(keys) // 2])
        for level in range(self.width - 1, -1, -1):  # between first words if possible
            border = middle >> (BITS * level) << (BITS * level)
            if border > keys[0]:
                break
        cut = int(np.searchsorted(keys, border))
        left, right = Container(part.low), Container(border)
        left.add(keys[:cut], n[:cut])
        right.add(keys[cut:], n[cut:])
        at = self.parts.index(part)
        self.parts[at:at + 1] = [left, right]
        self._burst(left)
        self._burst(right)

    def spill(self, keep: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until at most ``keep`` phrases are left."""
        left = len(self)
        for part in sorted(self.parts, key=lambda p: -p.used):
            if left <= keep or not part.used:
                break
            keys, n = part.items()
            order = np.argsort(keys)
            left -= part.used
            part.__init__(part.low)
            yield keys[order], n[order]
