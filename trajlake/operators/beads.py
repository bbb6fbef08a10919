"""Atom-to-bead assignment and bead aggregation.

Three stages, in order of priority, all sharing the rule "an atom belongs to
one bead": explicit id lists, id offsets from a center, nearest neighbours of
a center.  Each stage is joins and windows.  Only centers that compete for an
atom need the sequential rule; they are handed to a small grouped function per
conflict component.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.operators.components import connected_components
from trajlake.operators.joins import join_keys
from trajlake.operators.neighbors import LENGTHS, POSITION, candidate_pairs
from trajlake.operators.ordinals import bucketed_position
from trajlake.session import cut_lineage

EXPLICIT, OFFSET, DISTANCE = 1, 2, 3
MEMBER_TYPE = 2
ROW_BLOCK = 65_536
FRAME_PAIRS = 65_536  # contested pairs of a frame that are decided in one stream
ATOM_PAIRS = 32  # pairs an atom that a frame may have all of them


@dataclass(frozen=True)
class BeadRules:
    """What becomes a bead, and how its values are formed."""

    patterns: Sequence[Sequence[int]] = ((1, 2, 2),)
    center_type: int = 1
    r_cutoff: float | None = None
    cg_assignments: Sequence[tuple[Sequence[int], int]] = ()  # (atom ids, bead type)
    id_patterns: Sequence[tuple[Sequence[int], Sequence[int], int]] = ()  # (types, offsets, bead type)
    position_source: str = "unwrapped"
    unwrap_pbc: bool = False
    average_forces: bool = True
    average_potential_energy: bool = True
    force_energy_source: str = "average"
    # fixed values: carbon (type 1) and hydrogen (type 2)
    masses: dict[int, float] = field(default_factory=lambda: {1: 12.0, 2: 1.0})

    @property
    def unwrapped(self) -> bool:
        return self.unwrap_pbc or self.position_source == "unwrapped"

    def pattern_codes(self) -> list[int]:
        """Bead type of each pattern: numbered by first appearance."""
        seen: dict[tuple[int, ...], int] = {}
        return [seen.setdefault(tuple(p), len(seen) + 1) for p in self.patterns]

    def best_pattern(self) -> list[tuple[int, int, int]]:
        """(needed members, pattern number, members taken), most demanding first.

        With ``c`` members available the first entry whose need is <= c applies.
        """
        steps = []
        for need in sorted({list(p).count(MEMBER_TYPE) for p in self.patterns}):
            usable = [(1 + list(p).count(MEMBER_TYPE) - 0.01 * len(p), -i)
                      for i, p in enumerate(self.patterns) if list(p).count(MEMBER_TYPE) <= need]
            chosen = -max(usable)[1]
            steps.append((need, chosen, list(self.patterns[chosen]).count(MEMBER_TYPE)))
        return steps[::-1]

    def valid_id_patterns(self):
        """Usable id-offset rules as (rule number, types, offsets, bead type)."""
        return [(i, list(t), list(o), c) for i, (t, o, c) in enumerate(self.id_patterns)
                if len(t) >= 2 and len(t) == len(o) and o[0] == 0 and t[0] == self.center_type]

    def rule_warnings(self) -> list[str]:
        """Messages about id-offset rules that can not be used at all."""
        out = []
        for t, o, _ in self.id_patterns:
            if len(t) < 2 or len(t) != len(o):
                out.append(f"id pattern skipped: types {list(t)} and offsets {list(o)} differ in length or are too short")
            elif o[0] != 0:
                out.append(f"id pattern skipped: first offset must be 0, got {list(o)}")
        return out


def _case(count: Column, steps, pick: int) -> Column:
    out = F.lit(None).cast("int")
    for step in reversed(steps):
        out = F.when(count >= step[0], F.lit(step[pick])).otherwise(out)
    return out


# --- stage 1: explicit ids ---------------------------------------------------

def explicit_members(atoms: DataFrame, frame: Sequence[str], rules: BeadRules) -> DataFrame | None:
    """Atoms bound by an explicit id list; a rule is skipped in a frame where an
    earlier accepted rule already holds one of its atoms."""
    if not rules.cg_assignments:
        return None
    frame = list(frame)
    listed = [(n, int(i), int(t)) for n, (ids, t) in enumerate(rules.cg_assignments) for i in ids]
    # as long as the written rule list
    table = F.broadcast(atoms.sparkSession.createDataFrame(
        listed, "rule_no int, _id bigint, cg_type int").distinct())
    ids = F.coalesce(F.col("id"), F.col("row_idx") + 1)
    hits = atoms.select(*frame, "row_idx", ids.alias("_id")).join(table, "_id")

    id_sets = [set(map(int, ids)) for ids, _ in rules.cg_assignments]
    clashes = [(q, r) for r in range(len(id_sets)) for q in range(r) if id_sets[q] & id_sets[r]]
    if clashes:
        present = hits.groupBy(*frame).agg(F.collect_set("_id").alias("_present"))
        for r, own in enumerate(id_sets):
            def seen(values):
                return F.arrays_overlap("_present", F.array(*[F.lit(v).cast("bigint") for v in sorted(values)]))
            ok = seen(own) if own else F.lit(False)
            for q, rr in clashes:
                if rr == r:
                    ok = ok & ~(F.col(f"_ok{q}") & seen(id_sets[q] & own))
            present = present.withColumn(f"_ok{r}", ok)
        taken = F.array(*[F.when(F.col(f"_ok{r}"), F.lit(r)) for r in range(len(id_sets))])
        accepted = present.select(*frame, F.explode(F.array_compact(taken)).alias("rule_no"))
        hits = hits.join(accepted, [*frame, "rule_no"], "left_semi")

    bead = W.partitionBy(*frame, "rule_no")  # as many rows as the rule lists
    return hits.select(
        *frame, F.lit(EXPLICIT).alias("stage"), "rule_no",
        F.min("row_idx").over(bead).alias("center_row"), "cg_type",
        (F.row_number().over(bead.orderBy("row_idx")) - 1).alias("pos"), "row_idx")


# --- stage 2: id offsets -----------------------------------------------------

def offset_bindings(atoms: DataFrame, frame: Sequence[str], types: Sequence[int],
                    offsets: Sequence[int], center_type: int,
                    used: DataFrame | None = None) -> DataFrame:
    """One row per free center: its member rows, or the first reason why it fails.

    ``reason`` is NULL, 'missing', 'type' or 'taken'; ``bad_id`` is the id meant.
    """
    frame = list(frame)
    free = atoms if used is None else atoms.join(used, [*frame, "row_idx"], "left_anti")
    wanted = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(o).cast("bigint").alias("off"), F.lit(t).alias("want"))
                       for p, (o, t) in enumerate(zip(offsets, types)) if p > 0])
    probe = (free.where(F.col("type") == center_type)
             .select(*frame, F.col("row_idx").alias("center_row"), F.col("id").alias("center_id"),
                     F.explode(wanted).alias("w"))
             .select(*frame, "center_row", "center_id", "w.*",
                     (F.col("center_id") + F.col("w.off")).alias("id")))
    # a repeated id means its last row
    lookup = atoms.groupBy(*frame, "id").agg(
        F.max(F.struct("row_idx", "type")).alias("hit"))
    lookup = lookup.select(*frame, "id", "hit.row_idx", "hit.type")
    if used is None:
        lookup = lookup.withColumn("busy", F.lit(False))
    else:
        lookup = lookup.join(used.withColumn("busy", F.lit(True)), [*frame, "row_idx"], "left") \
            .withColumn("busy", F.coalesce("busy", F.lit(False)))
    found = probe.join(lookup, [*frame, "id"], "left")
    reason = (F.when(F.col("row_idx").isNull(), "missing")
              .when(F.col("type") != F.col("want"), "type")
              .when(F.col("busy"), "taken"))
    found = found.withColumn("reason", reason)
    return found.groupBy(*frame, "center_row", "center_id").agg(
        F.min_by("reason", F.when(F.col("reason").isNotNull(), F.col("pos"))).alias("reason"),
        F.min_by("id", F.when(F.col("reason").isNotNull(), F.col("pos"))).alias("bad_id"),
        F.array_sort(F.collect_list(F.struct("pos", "row_idx"))).alias("members"))


def _claims(bindings: DataFrame, frame: list[str]) -> DataFrame:
    """(frame, center_row, pos, row_idx) of complete bindings, center at pos 0."""
    every = F.concat(F.array(F.struct(F.lit(0).alias("pos"), F.col("center_row").alias("row_idx"))), F.col("members"))
    return (bindings.where(F.col("reason").isNull())
            .select(*frame, "center_row", F.explode(every).alias("m"))
            .select(*frame, "center_row", "m.pos", "m.row_idx"))


def _conflict_groups(rows: DataFrame, frame: list[str], atom: str, centers_are_atoms: bool = False) -> DataFrame:
    """Add ``_group``: the connected component of centers that share atoms, decided together."""
    wanted = rows.select(*frame, "center_row", atom)
    if centers_are_atoms:
        wanted = wanted.union(rows.select(*frame, "center_row", "center_row")).distinct()
    first = wanted.groupBy(*frame, atom).agg(F.min("center_row").alias("v"))
    links = wanted.join(first, [*frame, atom]).select(*frame, F.col("center_row").alias("u"), "v")
    parts = connected_components(links, frame).select(
        *frame, F.col("node").alias("center_row"), F.col("component").alias("_group"))
    return rows.join(parts, [*frame, "center_row"], "left").withColumn("_group", F.coalesce("_group", "center_row"))


def _in_groups(rows: DataFrame, frame: list[str], order: list[str]) -> DataFrame:
    """Bring each decision group into one sorted partition (sorting may spill)."""
    return (rows.repartition(*frame, "_group")
            .sortWithinPartitions(*frame, "_group", "center_row", *order))


def _first_come(frame: list[str]):
    """Stream sorted bindings; a center is kept when none of its atoms is taken.

    Only the taken atoms of the current group and the current binding are held.
    """
    def run(batches):
        group = center = None
        taken: set[int] = set()
        binding: list[tuple] = []

        def close():
            atoms = {b[-1] for b in binding}
            if binding and taken.isdisjoint(atoms):
                taken.update(atoms)
                return binding
            return []

        names = [*frame, "center_row", "pos", "row_idx"]
        for pdf in batches:
            out: list[tuple] = []
            for row, g in zip(pdf[names].itertuples(index=False, name=None), pdf["_group"]):
                here = (*row[:len(frame)], g)
                if here != group or row[-3] != center:
                    out += close()
                    if here != group:
                        taken = set()
                    group, center, binding = here, row[-3], []
                binding.append(row)
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame(close(), columns=names)

    return run


def offset_members(atoms: DataFrame, frame: Sequence[str], rule, center_type: int,
                   used: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Members accepted by one id-offset rule, and the binding table behind it."""
    frame = list(frame)
    number, types, offsets, cg_type = rule
    bindings = offset_bindings(atoms, frame, types, offsets, center_type, used)
    claims = _claims(bindings, frame)
    per_atom = W.partitionBy(*frame, "row_idx")
    per_center = W.partitionBy(*frame, "center_row")
    flagged = cut_lineage(claims.withColumn("_n", F.count(F.lit(1)).over(per_atom))
                          .withColumn("_open", F.max(F.col("_n") > 1).over(per_center)).drop("_n"))
    clean = flagged.where(~F.col("_open")).drop("_open")
    fought = _conflict_groups(flagged.where("_open").drop("_open"), frame, "row_idx")
    fought = _in_groups(fought, frame, ["pos"])
    settled = fought.mapInPandas(_first_come(frame), fought.drop("_group").schema)
    members = clean.unionByName(settled).select(
        *frame, F.lit(OFFSET).alias("stage"), F.lit(number).alias("rule_no"), "center_row",
        F.lit(cg_type).alias("cg_type"), "pos", "row_idx")
    return members, bindings


# --- stage 3: nearest neighbours ---------------------------------------------

def flag_contested(pairs: DataFrame, frame: Sequence[str]) -> DataFrame:
    """Add rank, n_cand and contested (some member is in reach of another center)."""
    frame = list(frame)
    per_member = W.partitionBy(*frame, "member_row")
    per_center = W.partitionBy(*frame, "center_row")
    return (pairs.withColumn("_n", F.count(F.lit(1)).over(per_member))
            .withColumns({
                "contested": F.max(F.col("_n") > 1).over(per_center),
                "n_cand": F.count(F.lit(1)).over(per_center),
                "rank": F.row_number().over(per_center.orderBy("d2", "member_row"))})
            .drop("_n"))


def _pattern_rows(chosen: DataFrame, frame: list[str], rules: BeadRules) -> DataFrame:
    """From (center_row, pattern_no, pos, row_idx) to the common member layout."""
    codes = F.array(*[F.lit(c) for c in rules.pattern_codes()])
    return chosen.select(
        *frame, F.lit(DISTANCE).alias("stage"), F.col("pattern_no").alias("rule_no"), "center_row",
        F.get(codes, F.col("pattern_no")).alias("cg_type"), "pos", "row_idx")


def settle_uncontested(flagged: DataFrame, frame: Sequence[str], rules: BeadRules) -> DataFrame:
    """Centers nobody competes with take their nearest members; pure SQL."""
    frame = list(frame)
    steps = rules.best_pattern()
    rows = (flagged.where(~F.col("contested"))
            .withColumns({"pattern_no": _case(F.col("n_cand"), steps, 1),
                          "_take": _case(F.col("n_cand"), steps, 2)})
            .where(F.col("pattern_no").isNotNull()))
    center = F.struct(F.lit(0).alias("pos"), F.col("center_row").alias("row_idx"))
    member = F.struct(F.col("rank").alias("pos"), F.col("member_row").alias("row_idx"))
    parts = F.array_compact(F.array(F.when(F.col("rank") == 1, center),
                                    F.when(F.col("rank") <= F.col("_take"), member)))
    rows = (rows.select(*frame, "center_row", "pattern_no", F.explode(parts).alias("m"))
            .select(*frame, "center_row", "pattern_no", "m.pos", "m.row_idx"))
    return _pattern_rows(rows, frame, rules)


def _greedy(frame: list[str], steps, shared_type: bool):
    """Stream sorted candidates; centers in row order take their nearest free members.

    Only the taken atoms of the current group and, per center, as many free
    candidates as the largest pattern needs are held.
    """
    most = steps[0][0]

    def run(batches):
        group = center = None
        taken: set[int] = set()
        free: list[int] = []

        def close():
            if center is None or (shared_type and center in taken):
                return []
            step = next((s for s in steps if s[0] <= len(free)), None)
            if step is None:
                return []
            atoms = [center, *free[:step[2]]]
            taken.update(atoms)
            return [(*group[:-1], center, step[1], pos, atom) for pos, atom in enumerate(atoms)]

        names = [*frame, "center_row", "pattern_no", "pos", "row_idx"]
        for pdf in batches:
            out: list[tuple] = []
            for *key, c, m in zip(*[pdf[k].tolist() for k in frame], pdf["_group"].tolist(),
                                  pdf["center_row"].tolist(), pdf["member_row"].tolist()):
                here = tuple(key)
                if here != group or c != center:
                    out += close()
                    if here != group:
                        taken = set()
                    group, center, free = here, c, []
                if len(free) < most and m not in taken:
                    free.append(m)
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame(close(), columns=names)

    return run


def settle_contested(flagged: DataFrame, frame: Sequence[str], rules: BeadRules) -> DataFrame:
    """Competing centers, decided in row order within their component."""
    frame = list(frame)
    shared = rules.center_type == MEMBER_TYPE
    rows = flagged.where("contested").select(*frame, "center_row", "member_row", "d2")
    # components only spread the work: frames of few pairs are a group as they are
    long = cut_lineage(rows.groupBy(*frame).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FRAME_PAIRS).drop("_n"))
    if long.isEmpty():
        rows = rows.withColumn("_group", F.lit(0).cast("bigint"))
    else:
        short = join_keys(rows, long, frame, "left_anti").withColumn("_group", F.lit(0).cast("bigint"))
        rows = short.unionByName(_conflict_groups(join_keys(rows, long, frame, "left_semi"), frame, "member_row", shared))
    rows = _in_groups(rows, frame, ["d2", "member_row"])
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*frame).schema],
                        "center_row bigint, pattern_no int, pos int, row_idx bigint"])
    chosen = rows.mapInPandas(_greedy(frame, rules.best_pattern(), shared), schema)
    return _pattern_rows(chosen, frame, rules)


def _frame_diagonal(atoms: DataFrame) -> float:
    """Largest possible minimum-image distance over all boxes."""
    row = atoms.agg(F.max(F.sqrt(sum(F.col(l) * F.col(l) for l in LENGTHS)) / 2).alias("d")).first()
    return float(row["d"] or 0.0)


def distance_members(atoms: DataFrame, frame: Sequence[str], rules: BeadRules) -> DataFrame:
    """Members bound by the nearest-neighbour patterns among the given free atoms."""
    frame = list(frame)
    if rules.r_cutoff is None:
        reach = _frame_diagonal(atoms) * (1 + 1e-9) or 1.0
        centers = F.count_if(F.col("type") == rules.center_type)
        pairs = centers * F.count_if(F.col("type") == MEMBER_TYPE)
        large = cut_lineage(atoms.groupBy(*frame).agg(pairs.alias("_p"), F.count(F.lit(1)).alias("_n"))
                            .where(F.col("_p") > ATOM_PAIRS * F.col("_n")).drop("_p", "_n"))
        # frames whose pairs are few all the same need no growing
        if large.isEmpty():
            return _within_cutoff(atoms, frame, rules, reach)
        return _within_cutoff(join_keys(atoms, large, frame, "left_anti"), frame, rules, reach).unionByName(
            _growing_cutoff(cut_lineage(join_keys(atoms, large, frame, "left_semi")), frame, rules, 2.0, reach))
    return _within_cutoff(atoms, frame, rules, float(rules.r_cutoff))


def _within_cutoff(atoms: DataFrame, frame: list[str], rules: BeadRules, cutoff: float) -> DataFrame:
    pairs = candidate_pairs(atoms, frame, cutoff, rules.center_type, MEMBER_TYPE)
    if rules.center_type == MEMBER_TYPE:
        # a center may itself be wanted: everybody in reach of somebody competes
        flagged = pairs.withColumn("contested", F.lit(True))
        flagged = cut_lineage(flagged)
        members = settle_contested(flagged, frame, rules)
    else:
        flagged = cut_lineage(flag_contested(pairs, frame))
        members = settle_uncontested(flagged, frame, rules).unionByName(
            settle_contested(flagged, frame, rules))
    lonely = next((s for s in rules.best_pattern() if s[0] == 0), None)
    if lonely is not None:  # a pattern without members also fits centers that reach nobody
        alone = (atoms.where(F.col("type") == rules.center_type)
                 .select(*frame, F.col("row_idx").alias("center_row"))
                 .join(flagged.select(*frame, "center_row").distinct(), [*frame, "center_row"], "left_anti")
                 .select(*frame, "center_row", F.lit(lonely[1]).alias("pattern_no"),
                         F.lit(0).alias("pos"), F.col("center_row").alias("row_idx")))
        members = members.unionByName(_pattern_rows(alone, frame, rules))
    return cut_lineage(members)  # values, numbers and notes all read them


def _growing_cutoff(atoms: DataFrame, frame: list[str], rules: BeadRules, first: float, reach: float) -> DataFrame:
    """The rule with cutoff ``reach``, decided with growing smaller cutoffs.

    Under a smaller cutoff every center up to the first one that can not fill
    the largest pattern has its final members, because its nearest free members
    are the same under both.  Those are kept; the rest of the
    frame is redone with four times the cutoff, until ``reach`` is reached.
    """
    most = rules.best_pattern()[0][0]
    done, open_atoms, cutoff = None, atoms, first
    while True:
        last = cutoff >= reach
        members = _within_cutoff(open_atoms, frame, rules, min(cutoff, reach))
        if last:
            return members if done is None else done.unionByName(members)
        full = members.groupBy(*frame, "center_row").agg((F.count(F.lit(1)) - 1).alias("_got"))
        centers = open_atoms.where(F.col("type") == rules.center_type).select(
            *frame, F.col("row_idx").alias("center_row"))
        if rules.center_type == MEMBER_TYPE:
            eaten = members.where(F.col("pos") > 0).select(*frame, F.col("row_idx").alias("center_row"))
            centers = centers.join(eaten, [*frame, "center_row"], "left_anti")
        stuck = (centers.join(full, [*frame, "center_row"], "left")
                 .where(F.coalesce("_got", F.lit(0)) < most)
                 .groupBy(*frame).agg(F.min("center_row").alias("_stuck")))
        final = cut_lineage(members.join(stuck, frame, "left")
                            .where(F.col("_stuck").isNull() | (F.col("center_row") < F.col("_stuck")))
                            .drop("_stuck"))
        done = final if done is None else done.unionByName(final)
        open_atoms = cut_lineage(open_atoms.join(stuck, frame, "left_semi").join(
            final.select(*frame, "row_idx"), [*frame, "row_idx"], "left_anti"))
        if open_atoms.isEmpty():
            return done
        cutoff *= 4


# --- all stages --------------------------------------------------------------

def assign_members(atoms: DataFrame, frame: Sequence[str], rules: BeadRules) -> tuple[DataFrame, DataFrame]:
    """(members, warnings) over the three stages.

    ``atoms`` carries px,py,pz,lx,ly,lz.  ``warnings`` has one row per center
    that an id-offset rule or the distance stage left out.
    """
    frame = list(frame)
    parts: list[DataFrame] = []
    notes: list[DataFrame] = []
    explicit = explicit_members(atoms, frame, rules)
    if explicit is not None:
        parts.append(cut_lineage(explicit))
    for rule in rules.valid_id_patterns():
        used = _used(parts, frame)
        members, bindings = offset_members(atoms, frame, rule, rules.center_type, used)
        members = cut_lineage(members)
        won = members.where(F.col("pos") == 0).select(*frame, "center_row")
        lost = bindings.join(won, [*frame, "center_row"], "left_anti")
        notes.append(lost.select(
            *frame, F.lit(OFFSET).alias("stage"), "center_row", "center_id",
            F.coalesce("reason", F.lit("taken")).alias("reason"), "bad_id"))
        parts.append(members)
    used = _used(parts, frame)
    free = atoms if used is None else atoms.join(used, [*frame, "row_idx"], "left_anti")
    nearest = distance_members(free, frame, rules)
    parts.append(nearest)
    unmatched = (free.where(F.col("type") == rules.center_type)
                 .select(*frame, F.col("row_idx").alias("center_row"), F.col("id").alias("center_id"))
                 .join(nearest.select(*frame, F.col("row_idx").alias("center_row")),
                       [*frame, "center_row"], "left_anti"))
    notes.append(unmatched.select(
        *frame, F.lit(DISTANCE).alias("stage"), "center_row", "center_id",
        F.lit("no pattern").alias("reason"), F.lit(None).cast("bigint").alias("bad_id")))
    return reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, notes)


def _used(parts: list[DataFrame], frame: list[str]) -> DataFrame | None:
    if not parts:
        return None
    return reduce(DataFrame.unionByName, [p.select(*frame, "row_idx") for p in parts])


def number_beads(members: DataFrame, frame: Sequence[str]) -> DataFrame:
    """(frame, stage, rule_no, center_row, id): ids 1..n by stage, rule, center."""
    frame = list(frame)
    # an id-offset or explicit rule number orders beads; a pattern number does not
    heads = members.where(F.col("pos") == 0).select(*frame, "stage", "rule_no", "center_row")
    rule = F.when(F.col("stage") == DISTANCE, F.lit(0)).otherwise(F.col("rule_no"))
    numbered = bucketed_position(
        heads, frame,
        {"_b0": F.col("stage"), "_b1": rule, "_b2": F.floor(F.col("center_row") / ROW_BLOCK)},
        [F.col("center_row")], "_at")
    return numbered.select(*frame, "stage", "rule_no", "center_row", (F.col("_at") + 1).alias("id"))


def bead_values(members: DataFrame, atoms: DataFrame, frame: Sequence[str],
                rules: BeadRules) -> DataFrame:
    """One row per bead: position of the center, force and energy of the members."""
    frame = list(frame)
    bead = [*frame, "stage", "rule_no", "center_row"]
    columns = ["row_idx", "type", *POSITION, "fx", "fy", "fz", "c_pe"]
    rows = members.join(atoms.select(*frame, *columns), [*frame, "row_idx"])
    mass = F.lit(None).cast("double")
    for kind, value in rules.masses.items():
        mass = F.when(F.col("type") == kind, F.lit(value)).otherwise(mass)
    center = {c: F.min_by(c, "pos") for c in ("fx", "fy", "fz", "c_pe")}
    if rules.force_energy_source == "center_only":
        force = {c: center[c] for c in ("fx", "fy", "fz")}
        energy = center["c_pe"]
    else:
        if rules.average_forces:
            total = F.sum("_mass")
            # the plain mean where no member has a mass, as in the audit
            force = {c: F.when(total > 0, F.sum(F.col(c) * F.col("_mass")) / total).otherwise(F.avg(c)) for c in ("fx", "fy", "fz")}
        else:
            force = {c: F.lit(0.0) for c in ("fx", "fy", "fz")}
        energy = F.avg("c_pe") if rules.average_potential_energy else F.lit(None).cast("double")
    return rows.withColumn("_mass", mass).groupBy(*bead).agg(
        F.first("cg_type").alias("type"),
        *[F.min_by(p, "pos").alias(c) for p, c in zip(POSITION, ("x", "y", "z"))],
        *[force[c].alias(c) for c in ("fx", "fy", "fz")],
        energy.alias("c_pe"),
        F.count(F.lit(1)).cast("int").alias("n_atoms"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "row_idx"))),
                    lambda m: m["row_idx"]).alias("atom_indices"))


def describe_rules(beads: DataFrame, rules: BeadRules) -> DataFrame:
    """Add match_status, manual_assignment and the rule behind each bead."""
    def by_rule(values, kind: str) -> Column:
        if not values:
            return F.lit(None).cast(kind)
        return F.get(F.array(*[F.lit(v).cast(kind) if not isinstance(v, Column) else v for v in values]),
                     F.col("rule_no"))

    lists = [F.array(*[F.lit(int(i)).cast("bigint") for i in ids]) for ids, _ in rules.cg_assignments]
    patterns = [F.array(*[F.lit(int(t)) for t in p]) for p in rules.patterns]
    offsets = [F.struct(F.array(*[F.lit(int(t)) for t in types]).alias("type_pattern"),
                        F.array(*[F.lit(int(o)) for o in offs]).alias("id_offsets"))
               for types, offs, _ in rules.id_patterns]
    stage = F.col("stage")
    return beads.withColumns({
        "match_status": F.when(stage == EXPLICIT, "manual").when(stage == OFFSET, "id_pattern").otherwise("pattern"),
        "manual_assignment": stage == EXPLICIT,
        "assigned_atom_ids": F.when(stage == EXPLICIT, by_rule(lists, "array<bigint>")),
        "pattern": F.when(stage == DISTANCE, by_rule(patterns, "array<int>")),
        "id_pattern": F.when(stage == OFFSET, by_rule(offsets, "struct<type_pattern:array<int>,id_offsets:array<int>>")),
    })


def build_beads(members: DataFrame, atoms: DataFrame, frame: Sequence[str],
                rules: BeadRules) -> DataFrame:
    """Numbered beads with their values and provenance."""
    frame = list(frame)
    bead = [*frame, "stage", "rule_no", "center_row"]
    beads = bead_values(members, atoms, frame, rules).join(number_beads(members, frame), bead)
    return describe_rules(beads, rules).select(
        *frame, "id", "type", "x", "y", "z", "fx", "fy", "fz", "c_pe", "n_atoms", "atom_indices",
        "match_status", "manual_assignment", "assigned_atom_ids", "pattern", "id_pattern")
