"""Periodic neighbour search through an equi-join on grid cells.

The box is cut into cells at least one cutoff wide; a center looks into its own
and the 26 surrounding cells, so the distance test runs behind a hash join on
(frame, cell) instead of a theta join per frame.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.functions.geometry import squared_distance

LENGTHS = ("lx", "ly", "lz")
CELL_ATOMS = 64  # of a frame, for each cell along an axis at most
POSITION = ("px", "py", "pz")


def with_position(atoms: DataFrame, unwrapped: bool = True) -> DataFrame:
    """Add px/py/pz: unwrapped coordinates where the frame has them, else wrapped."""
    cols = {}
    for p, c in zip(POSITION, ("x", "y", "z")):
        if unwrapped and f"{c}u" in atoms.columns:
            have = F.col("xu").isNotNull() & F.col("yu").isNotNull() & F.col("zu").isNotNull()
            cols[p] = F.when(have, F.col(f"{c}u")).otherwise(F.col(c))
        elif f"{c}u" in atoms.columns:
            cols[p] = F.coalesce(c, f"{c}u")
        else:
            cols[p] = F.col(c)
    return atoms.withColumns(cols)


def _cells_along(length: Column, cutoff: Column) -> Column:
    # a hair wider than the cutoff, so rounding can not hide a neighbour two cells away
    return F.greatest(F.floor(F.try_divide(length, cutoff * (1 + 1e-9))), F.lit(1)).cast("bigint")


def _cell_of(pos: Column, length: Column, count: Column) -> Column:
    turns = F.try_divide(pos, length)
    fraction = turns - F.floor(turns)
    return F.least(F.floor(fraction * count), count - 1).cast("bigint")


def largest_frame(atoms: DataFrame, frame: Sequence[str]) -> int:
    """Atoms of the frame that has most of them; counts by frame stay in the tasks."""
    return int(atoms.groupBy(*frame).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0)


def _with_cells(df: DataFrame, cutoff: Column, crowd: int | None = None) -> DataFrame:
    counts = {f"_n{i}": _cells_along(F.col(l), cutoff) for i, l in enumerate(LENGTHS)}
    if crowd is not None:
        counts = {c: F.least(n, F.lit(crowd // CELL_ATOMS + 1).cast("bigint")) for c, n in counts.items()}
    df = df.withColumns(counts)
    return df.withColumns({f"_c{i}": _cell_of(F.col(p), F.col(l), F.col(f"_n{i}"))
                           for i, (p, l) in enumerate(zip(POSITION, LENGTHS))})


def _cell_key(a: Column, b: Column, c: Column) -> Column:
    return (a * F.col("_n1") + b) * F.col("_n2") + c


def _around(i: int) -> Column:
    """The own and the next cells along an axis, each once, with the squared distance to it."""
    n, c, length = F.col(f"_n{i}"), F.col(f"_c{i}"), F.col(LENGTHS[i])
    turns = F.try_divide(F.col(POSITION[i]), length)
    inside = (turns - F.floor(turns)) * n - c  # place in the own cell, 0 to 1
    width = F.try_divide(length, n)
    low, high = F.greatest(inside, F.lit(0.0)) * width, F.greatest(1 - inside, F.lit(0.0)) * width

    def cell(step: int, gap: Column) -> Column:
        return F.struct(F.pmod(c + step, n).alias("c"), (gap * gap).alias("g"))

    own = F.struct(c.alias("c"), F.lit(0.0).alias("g"))
    return (F.when(n >= 3, F.array(own, cell(-1, low), cell(1, high)))
            .when(n == 2, F.array(own, cell(1, F.least(low, high)))).otherwise(F.array(own)))


def cell_pairs(centers: DataFrame, members: DataFrame, frame: Sequence[str],
               cutoff: float | Column, inclusive: bool = True, once: bool = False,
               crowd: int | None = None) -> DataFrame:
    """All (center, member) pairs of a frame within the cutoff.

    The cutoff is a number or an expression over the box lengths.  ``crowd``,
    the ``largest_frame``, keeps the cells of few atoms wide: a center is sent to
    each cell it looks into, which costs more than the pairs it spares there.

    Both inputs carry px,py,pz,lx,ly,lz; the other columns of ``members`` must
    not clash with those of ``centers`` (frame excepted).  Adds ``d2``.

    With ``once`` both inputs are the same atoms: of two cells only the lower
    one looks into the other, so atoms of different cells meet once.  Adds
    ``same_cell``; atoms of one cell still meet in both orders.
    """
    frame = list(frame)
    cutoff = cutoff if isinstance(cutoff, Column) else F.lit(float(cutoff))
    member_cells = _with_cells(members, cutoff, crowd)
    member_cells = member_cells.withColumn("_cell", _cell_key(F.col("_c0"), F.col("_c1"), F.col("_c2")))
    # a center is sent to up to 27 cells, a member to one: the box and the limit go with the member
    member_cells = member_cells.withColumn("_limit", cutoff * cutoff)
    member_cells = member_cells.withColumnsRenamed({c: f"_m{c}" for c in (*POSITION, *LENGTHS)})
    member_cells = member_cells.drop(*[f"_n{i}" for i in range(3)], *[f"_c{i}" for i in range(3)])

    probe = _with_cells(centers, cutoff, crowd)
    if once:
        probe = probe.withColumn("_home", _cell_key(F.col("_c0"), F.col("_c1"), F.col("_c2")))
    for i in range(3):
        probe = probe.withColumn(f"_a{i}", F.explode(_around(i)))
    # cells out of reach are left out, with room for rounding
    probe = probe.where(F.col("_a0.g") + F.col("_a1.g") + F.col("_a2.g") <= cutoff * cutoff * (1 + 1e-6))
    probe = probe.withColumn("_cell", _cell_key(F.col("_a0.c"), F.col("_a1.c"), F.col("_a2.c")))
    if once:  # being neighbours is mutual, also across the border of the box
        probe = probe.where(F.col("_cell") >= F.col("_home")).withColumn("same_cell", F.col("_cell") == F.col("_home")).drop("_home")
    probe = probe.drop(*[f"_{k}{i}" for k in "nca" for i in range(3)])

    d2 = squared_distance([F.col(p) for p in POSITION], [F.col(f"_m{p}") for p in POSITION],
                          [F.col(f"_m{l}") for l in LENGTHS])
    return (probe.join(member_cells, [*frame, "_cell"])
            .withColumn("d2", d2)
            .where(F.col("d2") <= F.col("_limit") if inclusive else F.col("d2") < F.col("_limit"))
            .drop("_cell", "_limit", *[f"_m{c}" for c in (*POSITION, *LENGTHS)]))


def _split(atoms: DataFrame, frame: Sequence[str], center_type: int, member_type: int):
    base = [*frame, *POSITION, *LENGTHS]
    centers = atoms.where(F.col("type") == center_type).select(
        *base, F.col("row_idx").alias("center_row"))
    members = atoms.where(F.col("type") == member_type).select(
        *base, F.col("row_idx").alias("member_row"))
    return centers, members


def candidate_pairs(atoms: DataFrame, frame: Sequence[str], cutoff: float,
                    center_type: int = 1, member_type: int = 2) -> DataFrame:
    """(frame, center_row, member_row, d2) for every free member in reach of a center."""
    centers, members = _split(atoms, frame, center_type, member_type)
    pairs = cell_pairs(centers, members, frame, cutoff, crowd=largest_frame(atoms, frame))
    if center_type == member_type:
        pairs = pairs.where(F.col("center_row") != F.col("member_row"))
    return pairs.select(*frame, "center_row", "member_row", "d2")


def nearest_members(atoms: DataFrame, frame: Sequence[str], cutoff: float, n: int,
                    center_type: int = 1, member_type: int = 2) -> DataFrame:
    """The ``n`` nearest members of every center within the cutoff.

    Adds ``rank`` 1..n by (distance, row).  Coincident atoms are collapsed
    before the join: of members sharing a position only the first ones by row
    can be among the nearest of anyone, and centers sharing a position have
    the same neighbours.  Copies therefore never produce all pairs.
    """
    frame = list(frame)
    keep = n + (1 if center_type == member_type else 0)
    centers, members = _split(atoms, frame, center_type, member_type)
    same_spot = W.partitionBy(*frame, *POSITION).orderBy("member_row")
    members = (members.withColumn("_r", F.row_number().over(same_spot))
               .where(F.col("_r") <= keep).drop("_r"))
    spots = centers.groupBy(*frame, *POSITION).agg(
        *[F.first(l).alias(l) for l in LENGTHS])
    found = cell_pairs(spots, members, frame, cutoff)
    by_spot = W.partitionBy(*frame, *POSITION).orderBy("d2", "member_row")
    found = (found.withColumn("rank", F.row_number().over(by_spot))
             .where(F.col("rank") <= keep)
             .select(*frame, *POSITION, "member_row", "d2", "rank"))
    out = centers.drop(*LENGTHS).join(found, [*frame, *POSITION])
    if center_type == member_type:
        own = W.partitionBy(*frame, "center_row").orderBy("d2", "member_row")
        out = (out.where(F.col("center_row") != F.col("member_row"))
               .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= n))
    return out.select(*frame, "center_row", "member_row", "d2", "rank")
