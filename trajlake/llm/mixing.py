"""Mixing sources to target weights by pivotal dependent rounding."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.llm.common import WORD, stored, text_or_empty

CYCLE = (5.0, 2.0, 1.0)
BUCKET = 2048  # documents paired with each other in one group


def share_out(sizes: Sequence[float], weights: Sequence[float], total: float, limit: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``limit`` times its size.

    What a source can't hold is shared anew by weight among the others, until
    none is above; sources with nothing get nothing.
    """
    out, free = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}
    left = total
    while free:
        weight = sum(weights[i] for i in free)
        full = {i for i in free if left * weights[i] / weight > limit * sizes[i]}
        if not full:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = limit * sizes[i]
            left -= out[i]
        free -= full
    return out


def _draw(key: int, seed: int) -> float:
    """A uniform number that depends on the document only (splitmix64)."""
    mask = 0xFFFFFFFFFFFFFFFF
    z = (key + seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & mask
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
    return ((z ^ (z >> 31)) >> 11) / float(1 << 53)


def pair_off(sizes: np.ndarray, parts: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Pair each open document with all later ones and move mass between them until it is 0 or 1.

    Give the largest first: the smaller ones share what it gains or loses, so
    what stays open at the end is small.  The draw keeps the document's
    expectation; where the later ones can hold only one of the two outcomes,
    that one is taken (so the last small ones lose part of their expectation
    to the sum: 0.31 to 0.55 instead of 0.4 in a bucket of 14), and where they can hold neither, they give or take all
    they have and the document stays open.  ``sizes * parts`` keeps its sum.
    Returns the parts and the place of the one still open (-1: none).
    """
    out = parts.copy()
    order = [i for i in range(len(out)) if 0.0 < out[i] < 1.0]
    rest = float(sum(float(sizes[i]) for i in order))
    mass = float(sum(float(sizes[i]) * out[i] for i in order))
    near = 1e-9 * max(1.0, rest)
    # the part of a later document is by now shift + scale * its first part
    shift, scale = 0.0, 1.0
    for n, i in enumerate(order):
        a, p = float(sizes[i]), min(1.0, max(0.0, shift + scale * parts[i]))
        rest -= a
        held = min(rest, max(0.0, mass - p * a))
        space = rest - held
        up, down = (1.0 - p) * a, p * a
        if min(up, down) <= near:  # at an end already, up to rounding
            out[i], mass = round(p), held
            continue
        can_rise, can_fall = up <= held + near, down <= space + near
        draw = _draw(int(keys[i]), seed)
        if not can_rise and not can_fall:
            rises = draw * (held + space) < space
            out[i] = p + held / a if rises else p - space / a
            out[order[n + 1:]] = 0.0 if rises else 1.0
            return out, i
        rises = draw < p if can_rise and can_fall else can_rise
        if rises:
            keep = max(0.0, held - up) / held if held > 0 else 0.0
            shift, scale = shift * keep, scale * keep
            out[i], mass = 1.0, max(0.0, held - up)
        else:
            keep = max(0.0, space - down) / space if space > 0 else 0.0
            shift, scale = 1.0 - keep + shift * keep, scale * keep
            out[i], mass = 0.0, min(rest, held + down)
    return out, -1


def _round_group(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "_key", "_tie"], ascending=[False, True, True], kind="stable", ignore_index=True)
        pdf["_part"], _ = pair_off(pdf["size"].to_numpy(), pdf["_part"].to_numpy(float), pdf["_key"].to_numpy(), seed)
        return pdf
    return run


def source_targets(sizes: DataFrame, *, cycle: Sequence[float] = CYCLE, total_factor: float = 1.5,
                   limit: float = 2.0) -> dict[str | None, tuple[int, float]]:
    """(source size, target) by source: one row per source reaches the driver."""
    held = {r["source"]: r["n"] for r in sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    names = sorted((s for s in held if s is not None)) + [None] * (None in held)
    weights = [cycle[i % len(cycle)] for i in range(len(names))]
    total = total_factor * sum(held.values())
    shares = share_out([held[s] for s in names], weights, total, limit)
    return {s: (held[s], t) for s, t in zip(names, shares)}


def mix_sources(docs: DataFrame, *, cycle: Sequence[float] = CYCLE, total_factor: float = 1.5, limit: float = 2.0,
                bucket: int = BUCKET, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", carry: Sequence[Column] = ()) -> DataFrame:
    """How many copies of each document the mix takes.

    A source's target over its size is the expected number of copies of each of
    its documents: a whole part, and a fraction that is decided by pairing.
    Documents of a source fall into buckets by a hash of their id; a bucket
    keeps the sum of size times fraction and leaves at most one document open,
    a small one as the large ones are decided first.
    The open ones meet in new buckets, level by level, until one document per
    source is left, which is rounded at random; so a source misses its target
    by less than that one document.  A bucket holds about ``bucket`` rows
    whatever the source's share of the rows; reruns agree because buckets and
    draws depend on ids and sizes, and rows that agree in both are told apart
    by the columns carried along.

    Columns: id, size (words), source_size, target, copies, taken.  A null text
    or one without words has size 0 and takes nothing.  Null is the last
    source.  Repeated rows are documents of their own.  An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    sizes = stored(docs.select(F.col(id_col), F.col(source_col).alias("source"), words.alias("size"), *carry))
    targets = source_targets(sizes, cycle=cycle, total_factor=total_factor, limit=limit)
    table = spark.createDataFrame([(s is None, s or "", n, t, t / n if n else 0.0) for s, (n, t) in targets.items()],
                                  "_null boolean, _name string, source_size bigint, target double, _rate double")
    rows = (sizes.withColumns({"_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))})
            .join(F.broadcast(table), ["_null", "_name"])
            .withColumns({"_whole": F.floor("_rate"), "_part": F.col("_rate") - F.floor("_rate"),
                          "_key": F.xxhash64(id_col, "size"),
                          "_tie": F.xxhash64(id_col, *[f"`{c}`" for c in sizes.columns[2:]])})
            .drop("_rate"))
    # a document without words can't be paired: it takes nothing
    rows = rows.withColumn("_part", F.when(F.col("size") > 0, F.col("_part")).otherwise(0.0))
    done, level = [], 0
    while True:
        split = (F.col("_part") > 0) & (F.col("_part") < 1)
        done.append(rows.where(~split))
        open_ = rows.where(split)
        counts = open_.groupBy("_null", "_name").agg(F.count(F.lit(1)).alias("_n"))
        if level and counts.where("_n > 1").isEmpty():
            done.append(open_.withColumn("_part", F.when(
                F.abs(F.xxhash64("_key", F.lit(seed))) % 1_000_003 < F.col("_part") * 1_000_003, 1.0).otherwise(0.0)))
            break
        buckets = F.ceil(F.col("_n") / bucket)
        grouped = (open_.join(F.broadcast(counts), ["_null", "_name"])
                   .withColumn("_bucket", F.pmod(F.xxhash64(F.col("_key"), F.lit(level)), buckets)).drop("_n"))
        rows = stored(grouped.groupBy("_null", "_name", "_bucket")
                      .applyInPandas(_round_group(seed + level), grouped.schema).drop("_bucket"))
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("_whole") + F.col("_part")).cast("bigint")
    return (out.withColumns({"copies": F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("bigint")})
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_null", "_name", "_whole", "_part", "_key", "_tie"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    Rows are known by 128 bits of hashes of all their columns, so null ids and
    ids repeated with other texts keep their own copies.  Rows that agree in
    every column share theirs evenly, the first ones taking what is left over.
    """
    def row_key(*first: Column) -> Column:
        return F.xxhash64(*first, *[F.struct(F.col(f"`{c}`"), F.col(f"`{c}`").isNull()) for c in docs.columns])

    keys = {"__key": row_key(), "__key2": row_key(F.lit(1))}
    mixed = mix_sources(docs, carry=[key.alias(name) for name, key in keys.items()], **options)
    times = mixed.groupBy(*keys).agg(F.sum("copies").alias("__all"), F.count(F.lit(1)).alias("__rows")).where("__all > 0")
    rows = docs.withColumns(keys).join(times, list(keys)).withColumn("__extra", F.col("__all") % F.col("__rows"))
    place = F.row_number().over(W.partitionBy(*keys).orderBy("__all"))
    even = rows.where("__extra = 0").withColumn("__place", F.lit(1))
    odd = rows.where("__extra > 0").withColumn("__place", place)  # only rows with equals
    each = (F.floor(F.col("__all") / F.col("__rows")) + F.when(F.col("__place") <= F.col("__extra"), 1).otherwise(0)).cast("int")
    return (even.unionByName(odd).withColumn("__times", each).where("__times > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*[f"`{c}`" for c in docs.columns]))


def apply_mix(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` repeated as often as the mix takes them, for ids that are unique and not null (else ``mix_documents``)."""
    times = copies.where("copies > 0").groupBy(id_col).agg(F.max("copies").cast("int").alias("__times"))
    return (docs.join(times, id_col).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
            .select(*docs.columns))
