"""Best-fit packing of tokenised documents with exact complements."""
from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import bound_batches, global_rank, literal_table, stored

LENGTH = 2048
MEMO = 150_000  # words of one generation whose ids a task remembers


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte inside a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordMemoTokenizer(dict):
    """Ids of whole texts, with the ids of units of a text remembered.

    The tokenizer always cuts before a blank or line feed that follows a
    character that isn't white space, and before a full stop or comma that
    follows a letter or digit.  The units between such places are encoded one
    by one.  A unit whose end makes the next cut uncertain has no ids of its own
    (None); its text is then cut with care, or not at all.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__({"": b""})
        self.older: dict[str, bytes | None] = {}  # the generation before, asked before the tokenizer
        self.joined: dict[str, bytes] = {}  # ids of what was cut with care
        self.whole = Tokenizer.from_file(path)
        self.words = self.whole.model
        self.letters = _byte_letters()
        # strings the tokenizer treats as one id wherever they stand
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def __missing__(self, unit: str) -> bytes | None:
        if unit in self.older:
            ids = self[unit] = self.older[unit]
            return ids
        last = unit[-1]
        sure = last.isalpha() or last.isdecimal() or unit in (".", ",")
        ids = self[unit] = self.ids_of(unit) if sure else None
        return ids

    def ids_of(self, unit: str) -> bytes:
        if unit.isalpha() or unit[0] == " " and unit[1:].isalpha():  # one word for the vocabulary
            return array("I", [t.id for t in self.words.tokenize(unit.encode().decode("latin-1").translate(self.letters))]).tobytes()
        return array("I", self.whole.encode(unit, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Unsigned 32-bit ids of the whole text, in the machine's (little-endian) order."""
        if "\x00" in text or any(s in text for s in self.special):
            return self.ids_of(text)
        if len(self) > MEMO:
            self.older = dict(self)
            self.clear()
            self[""] = b""
        if len(self.joined) > MEMO:
            self.joined.clear()
        units = (text.replace(" ", "\x00 ").replace("\n", "\x00\n").replace(".", "\x00.").replace(",", "\x00,").split("\x00"))
        if ".." not in text and ",," not in text and ".," not in text and ",." not in text:
            try:
                return b"".join(map(self.__getitem__, units))
            except TypeError:  # an uncertain unit
                pass
        out, held, known = [], "", self.joined
        for unit in units:
            if held:
                last = held[-1]
                sure = not last.isspace() if unit[:1] in " \n" else last.isalpha() or last.isdecimal()
                if sure:
                    ids = self.get(held) or known.get(held)
                    if ids is None:
                        ids = known[held] = self.ids_of(held)
                    out.append(ids)
                    held = ""
            held += unit
        if held:
            out.append(self.ids_of(held))
        return b"".join(out)


def _pieces(shared: Broadcast, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value[1] is None:  # a worker keeps it for all its tasks
            shared.value[1] = WordMemoTokenizer(shared.value[0] or tokenizer_path())
        tokens = shared.value[1]
        end = (0).to_bytes(4, "little")
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), (t.as_py() or "" for t in batch.column(1))
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(ids, texts):
                data = tokens.encode(text) + end
                n = len(data) // 4
                start = 0
                stop = n % length or length if n > length else n
                piece = 0
                while start < n:
                    for column, value in zip(out, (doc, piece, start, stop - start, zlib.crc32(data[4 * start:4 * stop]))):
                        column.append(value)
                    piece, start, stop = piece + 1, stop, stop + length
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *[pa.array(c, pa.int64()) for c in out[2:]]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, *, path: str | None = None, length: int = LENGTH, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): documents as token pieces of at most ``length``.

    A document is its ids and one 0.  A longer one is cut into whole pieces,
    of which the first holds the remainder.  A null text counts as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast([path, None])
    return (bound_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), text_col)
            .mapInArrow(_pieces(shared, length), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"))


def exact_fills(counts: Mapping[int, int], length: int) -> tuple[list[tuple[tuple[int, ...], int]], Counter]:
    """Combinations of lengths that fill a sequence exactly, largest member first.

    For each length from the top, what is missing to ``length`` is looked up as
    one other length, then as a sum of two, then of three; a combination is
    used as often as the counts allow.  Returns (lengths, times) and what is
    left.
    """
    left = np.zeros(length + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    fills = []

    def use(members: tuple[int, ...]) -> None:
        need = Counter(members)
        times = min(int(left[k]) // n for k, n in need.items())
        if times:
            fills.append((members, times))
            for k, n in need.items():
                left[k] -= times * n

    def pairs(total: int, top: int) -> list[tuple[int, int]]:
        """The sums of two lengths still there, both at most ``top``, larger first."""
        low, high = (total + 1) // 2, min(top, total - 1)
        if high < low:
            return []
        upper = np.arange(high, low - 1, -1)
        found = upper[(left[upper] > 0) & (left[total - upper] > 0)]
        return [(int(a), total - int(a)) for a in found]

    for first in range(length, 0, -1):
        gap = length - first
        if not left[first]:
            continue
        if not gap:
            use((first,))
            continue
        if gap <= first:
            use((first, gap))
        for a, b in pairs(gap, first):
            if not left[first]:
                break
            use((first, a, b))
        for a in range(min(gap - 2, first), (gap - 1) // 3, -1):
            if not left[first]:
                break
            for b, c in pairs(gap - a, a) if left[a] else ():
                if not left[first]:
                    break
                use((first, a, b, c))
    return fills, Counter({size: int(n) for size, n in enumerate(left) if n})


def best_fit(counts: Counter, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: equal lengths are placed together.

    Open sequences are kept as (members, times) by gap; a run of equal lengths
    goes to the smallest gap that holds it, as many copies of the sequence at
    once as there are.
    """
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    order: list[int] = []

    def put(gap: int, members: tuple[int, ...], times: int) -> None:
        if not gaps[gap]:
            order.insert(bisect_left(order, gap), gap)
        gaps[gap].append((members, times))

    def take(at: int) -> tuple[int, tuple[int, ...], int]:
        gap = order[at]
        members, times = gaps[gap].pop()
        if not gaps[gap]:
            order.pop(at)
        return gap, members, times

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(order, size)
            if at < len(order):
                gap, members, times = take(at)
                used = min(n, times)
                if times > used:
                    put(gap, members, times - used)
                put(gap - size, (*members, size), used)
                n -= used
            else:
                fit = length // size
                if n >= fit:
                    put(length - fit * size, (size,) * fit, n // fit)
                if n % fit:
                    put(length - (n % fit) * size, (size,) * (n % fit), 1)
                n = 0
    return [x for gap in order for x in gaps[gap]]


def plan_sequences(counts: Mapping[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(length, first, last, sequence, offset): which sequence a piece goes to by its place among equal lengths."""
    fills, left = exact_fills(counts, length)
    runs, place, sequence = [], Counter(), 0
    for members, times in fills + best_fit(left, length):
        offset = 0
        for size in members:
            runs.append((size, place[size], place[size] + times - 1, sequence, offset))
            place[size] += times
            offset += size
        sequence += times
    return runs


def pack(pieces: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (columns doc_id, piece, length).

    The plan is made on the number of pieces of each length, at most ``length``
    numbers, so the driver's work doesn't grow with the data.  The pieces are
    ranked by (length, id, piece) with a range sort, and the rank among equal
    lengths finds the run of the plan.  Equal lengths that hold most of the
    rows are spread by the other sort columns.
    """
    spark = pieces.sparkSession
    held = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = {}, 0
    for size in sorted(held):
        starts[size], total = total, total + held[size]
    rows = [(size, starts[size] + first, starts[size] + last, sequence - starts[size] - first, offset)
            for size, first, last, sequence, offset in plan_sequences(held, length)]
    table = literal_table(spark, rows, "length bigint,_from bigint,_to bigint,_shift bigint,offset bigint")
    ranked = global_rank(pieces, ["length", "doc_id", "piece", "start", "ids_crc32"], "_rank")
    return (ranked.join(F.broadcast(table), "length").where(F.col("_rank").between(F.col("_from"), F.col("_to")))
            .withColumn("sequence_id", F.col("_rank") + F.col("_shift")).drop("_rank", "_from", "_to", "_shift"))


def pack_documents(docs: DataFrame, *, path: str | None = None, length: int = LENGTH, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and offset each goes to.

    Empty and null texts are one piece of one token; repeated rows are pieces
    of their own; an empty table gives no pieces.
    """
    pieces = stored(token_pieces(docs, path=path, length=length, id_col=id_col, text_col=text_col))
    return pack(pieces, length=length).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
