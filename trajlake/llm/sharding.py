"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only."""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import global_rank, literal_table, stored, text_or_empty

RING = 1 << 32
SLICE = 20  # ring slices of 2^20 positions find the arc by equality


def virtual_nodes(shards: int, replicas: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise."""
    points = {}
    for shard in range(shards):
        for replica in range(replicas):
            digest = hashlib.blake2b(f"{shard}/{replica}".encode(), digest_size=4).digest()
            points.setdefault(int.from_bytes(digest, "big"), shard)
    return sorted(points.items())


def ring_position(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 32)


def _arc_slices(points: Sequence[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(slice, first, last, arc): arc i ends at node i, the last one wraps to node 0."""
    rows, low = [], 0
    for arc, high in enumerate([p for p, _ in points] + [RING - 1]):
        for part in range(low >> SLICE, (high >> SLICE) + 1) if low <= high else ():
            rows.append((part, max(low, part << SLICE), min(high, ((part + 1) << SLICE) - 1), arc))
        low = high + 1
    return rows


def ring_plan(counts: Sequence[int], owners: Sequence[int], capacity: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first, last, shard, slot) runs of the ring order.

    Every arc fills its own shard as far as there is room; what is left goes on
    clockwise to the next virtual node whose shard has room.
    """
    room, used = list(capacity), [0] * len(capacity)
    runs, over, start = [], [], 0

    def place(arc: int, first: int, n: int, shard: int) -> int:
        n = min(n, room[shard])
        if n:
            runs.append((arc, first, first + n - 1, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return n

    for arc, n in enumerate(counts):
        done = place(arc, start, n, owners[arc])
        if done < n:
            over.append((arc, start + done, n - done))
        start += n
    for arc, first, left in over:
        at = arc
        while left:
            at = (at + 1) % len(owners)
            done = place(arc, first, left, owners[at])
            first, left = first + done, left - done
    return runs


def shard_by_ring(docs: DataFrame, shards: int = 40, *, replicas: int = 64, load_factor: float | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every document into a shard: equal texts share a ring position.

    A shard takes at most ``ceil(load_factor * n / shards)`` documents; without
    a factor exactly ``n // shards`` or one more, so that all counts are at most
    one apart.  Equal texts stay together unless their shard fills; the rest of
    the group continues clockwise.  Inside a position the order is a hash of
    the id, so a hot text spreads over the range partitions of the sort.

    What reaches the driver are the document counts of ``shards * replicas``
    arcs; what is broadcast are that many runs and 4,096 ring slices.

    Columns: id, size (UTF-8 bytes + 16), text_crc32, shard, slot.  A null text
    has no bytes; null ids and repeated rows are placed as rows of their own.
    """
    spark = docs.sparkSession
    points = virtual_nodes(shards, replicas)
    owners = [s for _, s in points] + [points[0][1]]
    slices = literal_table(spark, _arc_slices(points), "_slice bigint,_low bigint,_high bigint,_arc int")
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col), (F.octet_length(text) + 16).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"), ring_position(text).alias("_at"))
    rows = stored(rows.withColumn("_slice", F.shiftright("_at", SLICE)).join(F.broadcast(slices), "_slice")
                  .where(F.col("_at").between(F.col("_low"), F.col("_high")))
                  .select(id_col, "size", "text_crc32", "_at", "_arc", F.xxhash64(id_col).alias("_tie")))
    held = {r["_arc"]: r["n"] for r in rows.groupBy("_arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [held.get(arc, 0) for arc in range(len(owners))]
    total = sum(counts)
    if load_factor is None:
        capacity = [total // shards + (s < total % shards) for s in range(shards)]
    else:
        if load_factor < 1:
            raise ValueError("load_factor is at least 1")
        capacity = [-int(-(load_factor * total) // shards)] * shards
    runs = literal_table(spark, ring_plan(counts, owners, capacity),
                         "_arc int,_from bigint,_to bigint,shard int,_slot bigint")
    placed = global_rank(rows, ["_at", "_tie", id_col, "size", "text_crc32"], "_rank")
    return (placed.join(F.broadcast(runs), "_arc").where(F.col("_rank").between(F.col("_from"), F.col("_to")))
            .select(id_col, "size", "text_crc32", "shard",
                    (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot")))
