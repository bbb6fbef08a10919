"""A priority queue of bounded memory: what doesn't fit waits in sorted runs in the shared folder."""
from __future__ import annotations

import heapq
import pickle
import uuid
from collections.abc import Iterator

from pyarrow import fs

BLOCK = 4096  # entries read from a run at once


class SpillingQueue:
    """Tuples by their order, the least first; at most ``most`` of them in memory besides a block of each run.

    A full queue writes its later half as one sorted run below ``folder``; an
    entry that is pushed later goes to memory again.  The least of the heap and
    of the heads of the runs comes out next.  ``close`` deletes the runs; a
    lost task leaves them to whoever deletes the folder.
    """

    def __init__(self, folder: str, most: int = 100_000):
        self.folder, self.most = folder, max(2, most)
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (next entry, number of its run)
        self.runs: list[Iterator[tuple]] = []
        self.paths: list[str] = []
        self.spilled = 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.most:
            self.heap.sort()
            keep = self.most // 2
            self._spill(self.heap[keep:])
            del self.heap[keep:]

    def _spill(self, entries: list[tuple]) -> None:
        system, root = fs.FileSystem.from_uri(self.folder)
        system.create_dir(root, recursive=True)
        path = f"{root}/run-{uuid.uuid4().hex}"
        with system.open_output_stream(path) as out:
            for at in range(0, len(entries), BLOCK):
                pickle.dump(entries[at:at + BLOCK], out)
        self.paths.append(path)
        self.spilled += len(entries)
        self.runs.append(self._read(system, path))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(system, path: str) -> Iterator[tuple]:
        with system.open_input_file(path) as src:
            while src.tell() < src.size():
                yield from pickle.load(src)

    def _advance(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heads, (entry, run))

    def least(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            entry, run = heapq.heappop(self.heads)
            self._advance(run)
            return entry
        return heapq.heappop(self.heap)

    def close(self) -> None:
        for run in self.runs:
            run.close()
        for path in self.paths:
            fs.FileSystem.from_uri(self.folder)[0].delete_file(path)
        self.heap, self.heads, self.runs, self.paths = [], [], [], []
