"""Frames as training rows: type codes, packed vectors, set numbers."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.joins import join_keys
from trajlake.operators.ordinals import ranged_position

CHUNK_BEADS = 65_536


def type_codes(beads: DataFrame, frame: Sequence[str], source: str | None = "type",
               out: str = "code", number: str = "id") -> DataFrame:
    """Add the 0-based dense code of a bead's type within its frame.

    The few distinct types of a frame are listed first and looked up per block
    of bead numbers, so no frame is sorted or joined in one task.
    ``source=None`` gives code 0 everywhere.
    """
    frame = list(frame)
    if source is None:
        return beads.withColumn(out, F.lit(0))
    rows = beads.withColumn("_block", F.floor(F.col(number) / CHUNK_BEADS))
    found = rows.select(*frame, "_block", F.col(source).cast("bigint").alias("_t")).distinct()
    kinds = found.groupBy(*frame).agg(F.array_sort(F.collect_set("_t")).alias("_types"),
                                      F.collect_set("_block").alias("_blocks"))
    kinds = kinds.select(*frame, "_types", F.explode("_blocks").alias("_block"))
    return rows.join(kinds, [*frame, "_block"]).withColumn(
        out, (F.array_position("_types", F.col(source).cast("bigint")) - 1).cast("int")).drop("_types", "_block")


def pack_frames(beads: DataFrame, frame: Sequence[str], chunk: int = CHUNK_BEADS) -> DataFrame:
    """(frame, chunk, n, coord, force, atom_ener, codes, energy), beads by id.

    A frame is one row unless it holds more than ``chunk`` beads; then it
    continues in further rows, so no row outgrows a task.
    """
    rows = beads.withColumn("chunk", F.floor((F.col("id") - 1) / chunk))
    packed = rows.groupBy(*frame, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("id", "x", "y", "z", "fx", "fy", "fz", "c_pe", "code"))).alias("_b"))
    return _flat(packed, frame)


def _flat(packed: DataFrame, keep: Sequence[str]) -> DataFrame:
    def flat(*names: str) -> Column:
        return F.flatten(F.transform("_b", lambda b: F.array(*[b[n] for n in names])))

    return packed.select(
        *keep, "chunk", F.size("_b").cast("bigint").alias("n"), flat("x", "y", "z").alias("coord"),
        flat("fx", "fy", "fz").alias("force"), F.transform("_b", lambda b: b["c_pe"]).alias("atom_ener"),
        F.transform("_b", lambda b: b["code"]).alias("codes"),
        F.aggregate(F.transform("_b", lambda b: b["c_pe"]), F.lit(0.0), lambda a, e: a + e).alias("energy"))


def pack_typed_frames(beads: DataFrame, frame: Sequence[str], source: str | None = "type", carry: Sequence[str] = (),
                      chunk: int = CHUNK_BEADS) -> DataFrame:
    """Like ``pack_frames``, with the types themselves in ``kinds``, and the ``carry`` columns of the frame.

    ``frame_heads`` and ``coded`` turn kinds into codes once all chunks of a frame are
    known, so that beads are aggregated once and only packed rows are joined.
    """
    kind = F.lit(0).cast("bigint") if source is None else F.col(source).cast("bigint")
    rows = beads.select(*frame, *carry, "id", "x", "y", "z", "fx", "fy", "fz", "c_pe", kind.alias("code"))
    labels = rows.withColumn("chunk", F.floor((F.col("id") - 1) / chunk)).groupBy(*frame, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("id", "x", "y", "z", "fx", "fy", "fz", "c_pe", "code"))).alias("_b"),
        *[F.first(c).alias(c) for c in carry])
    return _flat(labels, [*frame, *carry]).withColumnRenamed("codes", "kinds")


def frame_heads(packed: DataFrame, frame: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """(frame, carry, n_beads, total_energy, types): one row a frame; types ascending."""
    own = F.array_compact(F.array_distinct("kinds"))
    return packed.select(*frame, *carry, "n", "energy", own.alias("_k")).groupBy(*frame).agg(
        *[F.first(c).alias(c) for c in carry], F.sum("n").alias("n_beads"), F.sum("energy").alias("total_energy"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_k")))).alias("types"))


def coded(packed: DataFrame) -> DataFrame:
    """Kinds as 0-based places among the frame's ``types``."""
    return packed.withColumn("codes", F.transform("kinds", lambda k: (F.array_position("types", k) - 1).cast("int"))).drop("kinds", "types")


def frame_energy(packed: DataFrame, frame: Sequence[str]) -> DataFrame:
    return packed.groupBy(*frame).agg(F.sum("energy").alias("energy"), F.sum("n").alias("n"))


def bead_count_groups(packed: DataFrame, group: Sequence[str], frame: Sequence[str]) -> DataFrame:
    """(group, n_beads, n_frames): frames of different size never share a set."""
    sizes = packed.groupBy(*group, *frame).agg(F.sum("n").alias("n_beads"))
    return sizes.groupBy(*group, "n_beads").agg(F.count(F.lit(1)).alias("n_frames"))


def file_boxes(boxes: DataFrame) -> DataFrame:
    """(file, cell, varies): the last box row of each file and whether boxes differ."""
    return boxes.groupBy("file").agg(
        F.max_by("cell", "row_no").alias("cell"), (F.min("cell") != F.max("cell")).alias("varies"))


def split_sets(frames: DataFrame, group: Sequence[str], num_sets: int, order: Sequence[Column]) -> DataFrame:
    """Add frame_no and set_id: contiguous sets per group, larger sets first."""
    group = list(group)
    placed = ranged_position(frames, group, order, "frame_no")
    totals = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    small = F.floor(F.col("_n") / num_sets)
    extra = F.col("_n") % num_sets
    cut = extra * (small + 1)
    set_id = F.when(F.col("frame_no") < cut, F.floor(F.col("frame_no") / (small + 1))).otherwise(
        extra + F.floor((F.col("frame_no") - cut) / F.greatest(small, F.lit(1))))
    return join_keys(placed, totals, group).withColumn("set_id", set_id.cast("bigint")).drop("_n")


def type_map(packed: DataFrame, group: Sequence[str], frame: Sequence[str]) -> DataFrame:
    """(group, codes, type_map): types of the first frame and its ``CG<code>`` names."""
    first = packed.groupBy(*group).agg(F.min(F.struct(*frame)).alias("_f"))
    first = first.select(*group, *[F.col(f"_f.{c}").alias(c) for c in frame if c not in group])
    rows = join_keys(packed, first, [*group, *[c for c in frame if c not in group]], "left_semi")
    names = rows.select(*group, F.explode("codes").alias("_c")).distinct().groupBy(*group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_c")), lambda c: F.concat(F.lit("CG"), c)), " ").alias("type_map"))
    return join_keys(rows.select(*group, "chunk", "codes"), names, list(group))
