"""Bead audit: do stored beads agree with their source atoms?

Beads: frame keys, id, type, x, y, z, fx, fy, fz, c_pe, atom_indices,
manual_assignment, assigned_atom_ids.  Atoms: frame keys, row_idx, id, type,
px, py, pz, lx, ly, lz, fx, fy, fz, c_pe (already unwrapped if the beads were).
Every check is joins on (frame, row) plus small aggregates per bead.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import pbc_abs_diff
from trajlake.operators.beads import BeadRules
from trajlake.operators.neighbors import LENGTHS, POSITION
from trajlake.session import cut_lineage

# fixed values: columns of the audit report
REPORT_COLUMNS = ("file", "sim", "temp", "timestep", "check", "severity", "cg_id", "message", "n_atoms",
                  "member_atom_ids", "force_err", "pe_err", "pos_err", "pbc_span_frac_x", "pbc_span_frac_y",
                  "pbc_span_frac_z")
DETAILS = {"n_atoms": "bigint", "member_atom_ids": "string", "force_err": "double", "pe_err": "double",
           "pos_err": "double", "pbc_span_frac_x": "double", "pbc_span_frac_y": "double", "pbc_span_frac_z": "double"}


def bead_members(beads: DataFrame, atoms: DataFrame, frame: Sequence[str]) -> DataFrame:
    """One row per bead member; atom columns are NULL for an index out of range."""
    frame = list(frame)
    members = beads.select(*frame, F.col("id").alias("cg_id"), F.posexplode("atom_indices").alias("pos", "row_idx"))
    members = members.withColumn("row_idx", F.col("row_idx").cast("bigint"))
    found = atoms.select(*frame, "row_idx", F.col("id").alias("atom_id"), F.col("type").alias("atom_type"),
                         *POSITION, *LENGTHS, *[F.col(c).alias(f"a_{c}") for c in ("fx", "fy", "fz", "c_pe")])
    return members.join(found, [*frame, "row_idx"], "left")


def recompute(beads: DataFrame, atoms: DataFrame, frame: Sequence[str], rules: BeadRules) -> DataFrame:
    """Beads with n_members, n_lost, pos_err, force_err, pe_err and spans.

    One aggregate per bead serves the conservation and the span check.
    """
    frame = list(frame)
    mass = F.lit(None).cast("double")
    for kind, value in rules.masses.items():
        mass = F.when(F.col("atom_type") == kind, F.lit(value)).otherwise(mass)
    axes = ("x", "y", "z")
    rows = bead_members(beads, atoms, frame).withColumn("_m", mass)
    lost = F.col("atom_id").isNull() & F.col("px").isNull() & F.col("lx").isNull()
    total = F.sum("_m")
    if rules.force_energy_source == "center_only":
        force = {c: F.min_by(f"a_{c}", "pos") for c in ("fx", "fy", "fz")}
        energy = F.min_by("a_c_pe", "pos")
    else:
        force = {c: (F.when(total > 0, F.sum(F.col(f"a_{c}") * F.col("_m")) / total).otherwise(F.avg(f"a_{c}"))
                     if rules.average_forces else F.lit(0.0)) for c in ("fx", "fy", "fz")}
        energy = F.avg("a_c_pe") if rules.average_potential_energy else F.lit(None).cast("double")
    members = rows.groupBy(*frame, "cg_id").agg(
        F.count(F.lit(1)).alias("n_members"), F.count_if(lost).alias("n_lost"),
        *[F.min_by(p, "pos").alias(f"_x{i}") for i, p in enumerate(POSITION)],
        *[(F.max(p) - F.min(p)).alias(f"_s{i}") for i, p in enumerate(POSITION)],
        *[F.first(l, ignorenulls=True).alias(f"_l{i}") for i, l in enumerate(LENGTHS)],
        *[force[c].alias(f"_{c}") for c in ("fx", "fy", "fz")], energy.alias("_pe"))
    out = beads.withColumnRenamed("id", "cg_id").join(members, [*frame, "cg_id"], "left")
    pos_err = F.greatest(*[pbc_abs_diff(F.col(f"_x{i}"), F.col(a), F.col(f"_l{i}")) for i, a in enumerate(axes)])
    force_err = F.greatest(*[F.abs(F.col(f"_{c}") - F.col(c)) for c in ("fx", "fy", "fz")])
    fractions = F.array(*[F.try_divide(f"_s{i}", f"_l{i}") for i in range(3)])
    return out.withColumns({
        "n_members": F.coalesce("n_members", F.lit(0)), "n_lost": F.coalesce("n_lost", F.lit(0)),
        "pos_err": pos_err, "force_err": force_err,
        "pe_err": F.coalesce(F.abs(F.col("_pe") - F.col("c_pe")), F.lit(0.0)),
        "span_frac": fractions,
        "flat_box": F.coalesce(reduce(lambda a, b: a | b, [F.abs(F.col(f"_l{i}")) < 1e-12 for i in range(3)]), F.lit(True)),
    }).drop(*[f"_{k}{i}" for k in "xsl" for i in range(3)], "_fx", "_fy", "_fz", "_pe")


def _issue(df: DataFrame, frame: list[str], check: str, severity: Column, cg_id: Column, message: Column,
           **details: Column) -> DataFrame:
    return df.select(
        *frame, F.lit(check).alias("check"), severity.alias("severity"), cg_id.cast("bigint").alias("cg_id"),
        message.alias("message"),
        *[details.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in DETAILS.items()])


def conservation_issues(checked: DataFrame, frame: Sequence[str], force_tol: float = 1e-4,
                        pe_tol: float = 1e-6) -> DataFrame:
    frame = list(frame)
    wrong = ((F.col("pos_err") > 1e-9) | (F.col("force_err") > force_tol) | (F.col("pe_err") > pe_tol))
    kind = (F.when(F.col("n_members") == 0, "bead without members")
            .when(F.col("n_lost") > 0, "member outside the frame")
            .when(wrong, F.format_string("stored values differ: position by %.2e, force by %.2e, energy by %.2e",
                                         "pos_err", "force_err", "pe_err")))
    whole = (F.col("n_members") > 0) & (F.col("n_lost") == 0)

    def value(c: str) -> Column:
        return F.when(whole, F.col(c))

    bad = checked.withColumn("_k", kind).where(F.col("_k").isNotNull())
    return _issue(bad, frame, "conservation", F.lit("FAIL"), F.col("cg_id"), F.col("_k"),
                  n_atoms=value("n_members"), force_err=value("force_err"), pe_err=value("pe_err"),
                  pos_err=value("pos_err"))


def worst_errors(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest recompute errors per key, over beads whose members were all found."""
    whole = (F.col("n_members") > 0) & (F.col("n_lost") == 0)
    return checked.groupBy(*keys).agg(*[
        F.coalesce(F.max(F.when(whole, F.col(c))), F.lit(0.0)).alias(f"worst_{c}") for c in ("force_err", "pe_err", "pos_err")])


def span_issues(checked: DataFrame, atoms: DataFrame, frame: Sequence[str], threshold: float = 0.45) -> DataFrame:
    """Beads whose members spread over too much of the box; manual beads are exempt.

    Member ids are looked up for the failing beads only.
    """
    frame = list(frame)
    rows = checked.where(~F.coalesce("manual_assignment", F.lit(False)) & (F.col("n_members") >= 2)
                         & (F.col("n_lost") == 0) & ~F.col("flat_box"))
    worst = F.array_max("span_frac")
    axis = F.get(F.array(F.lit("x"), F.lit("y"), F.lit("z")), (F.array_position("span_frac", worst) - 1).cast("int"))
    severity = F.when(worst > threshold, "FAIL").when(worst > 0.5 * threshold, "WARN")
    message = F.format_string("members cover %.1f%% of the box along %s", worst * 100, axis)
    rows = rows.withColumn("_s", severity).where(F.col("_s").isNotNull())
    fails = rows.where(F.col("_s") == "FAIL").select(*frame, F.col("cg_id").alias("id"), "atom_indices")
    names = bead_members(fails, atoms, frame).groupBy(*frame, "cg_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "atom_id"))), lambda m: m["atom_id"].cast("string")), ";").alias("member_atom_ids"))
    rows = rows.join(names, [*frame, "cg_id"], "left")
    return _issue(rows, frame, "pbc", F.col("_s"), F.col("cg_id"), message,
                  member_atom_ids=F.when(F.col("_s") == "FAIL", F.col("member_atom_ids")),
                  **{f"pbc_span_frac_{a}": F.col("span_frac")[i] for i, a in enumerate("xyz")})


def _uses(beads: DataFrame, atoms: DataFrame, frame: list[str]) -> DataFrame:
    """(frame, row_idx, atom_id, real, uses) of every atom and every member index of the frames with beads."""
    members = beads.select(*frame, F.explode(F.col("atom_indices").cast("array<bigint>")).alias("row_idx")).groupBy(*frame, "row_idx").agg(
        F.count(F.lit(1)).alias("uses"))
    found = atoms.select(*frame, "row_idx", F.col("id").alias("atom_id"), F.lit(True).alias("real"))
    return found.join(members, [*frame, "row_idx"], "full").join(beads.select(*frame).distinct(), frame, "left_semi")


def coverage_atoms(beads: DataFrame, atoms: DataFrame, frame: Sequence[str]) -> DataFrame:
    """(frame, row_idx, atom_id, uses): every atom that is not in exactly one bead.

    An index without an atom has no atom_id and counts when it is used more
    than once.
    """
    frame = list(frame)
    rows = _uses(beads, atoms, frame).withColumn("uses", F.coalesce("uses", F.lit(0)).cast("bigint"))
    return rows.where("uses <> 1").select(*frame, "row_idx", "atom_id", "uses")


def coverage_issues(beads: DataFrame, atoms: DataFrame, frame: Sequence[str]) -> DataFrame:
    """Every atom of a frame with beads must be in exactly one bead; one issue per frame and kind, with the count.

    ``coverage_atoms`` lists the atoms.
    """
    frame = list(frame)
    sizes = _uses(beads, atoms, frame).groupBy(*frame).agg(
        F.coalesce(F.sum("uses"), F.lit(0)).alias("seen"), F.count("real").alias("atoms"),
        F.count_if(F.col("uses").isNull()).alias("missing"), F.count_if(F.col("uses") > 1).alias("doubled"))
    clean = (F.col("missing") == 0) & (F.col("doubled") == 0)
    notes = F.array_compact(F.array(
        F.when(F.col("missing") > 0, F.struct(F.lit("atoms in no bead").alias("message"), F.col("missing").alias("n"))),
        F.when(F.col("doubled") > 0, F.struct(F.lit("atoms in several beads").alias("message"), F.col("doubled").alias("n"))),
        F.when(clean & (F.col("seen") != F.col("atoms")), F.struct(
            F.lit("members and atoms differ in number").alias("message"), (F.col("seen") - F.col("atoms")).alias("n")))))
    rows = sizes.select(*frame, F.explode(notes).alias("note"))
    return _issue(rows, frame, "coverage", F.lit("FAIL"), F.lit(None), F.col("note.message"), n_atoms=F.col("note.n"))


def rule_issues(beads: DataFrame, frame: Sequence[str], rules: BeadRules) -> DataFrame | None:
    """Declared id lists against beads marked manual, both ways, by sorted ids."""
    if not rules.cg_assignments:
        return None
    frame = list(frame)
    wanted: dict[tuple[int, ...], int] = {}
    for ids, kind in rules.cg_assignments:
        if len(ids):
            wanted[tuple(sorted(int(i) for i in ids))] = kind
    literal = F.array(*[F.struct(F.array(*[F.lit(i).cast("bigint") for i in ids]).alias("ids"),
                                 F.lit(kind).alias("want")) for ids, kind in wanted.items()])
    declared = beads.select(*frame).distinct().select(*frame, F.explode(literal).alias("d")).select(*frame, "d.*")
    # many copies of one rule only count; the single type and id are kept as extremes
    manual = beads.where("manual_assignment").select(
        *frame, F.array_sort("assigned_atom_ids").alias("ids"), "type", "id").where(F.size("ids") > 0)
    stored = manual.groupBy(*frame, "ids").agg(
        F.count(F.lit(1)).alias("_n"), F.min("type").alias("_type"), F.min("id").alias("_id"))
    both = declared.join(stored, [*frame, "ids"], "full")
    name = F.array_join(F.transform("ids", lambda v: v.cast("string")), ",")
    kind = (F.when(F.col("want").isNull(), "marked manual without a rule")
            .when(F.col("_n").isNull(), "rule without a bead")
            .when(F.col("_n") > 1, "several beads of one rule")
            .when(F.col("_type") != F.col("want"), "bead of another type than its rule"))
    rows = both.withColumn("_k", kind).where(F.col("_k").isNotNull())
    severity = F.when(F.col("want").isNull(), "WARN").otherwise("FAIL")
    cg_id = F.when(F.col("_k") == "bead of another type than its rule", F.col("_id"))
    return _issue(rows, frame, "manual", severity, cg_id, F.concat_ws(": ", "_k", name), n_atoms=F.col("_n"))


def audit_issues(beads: DataFrame, atoms: DataFrame, frame: Sequence[str], rules: BeadRules,
                 checks: Sequence[str] = ("pbc", "conservation", "coverage", "manual"),
                 force_tol: float = 1e-4, pe_tol: float = 1e-6, span: float = 0.45) -> DataFrame:
    """Union of the chosen checks."""
    parts = []
    if "pbc" in checks or "conservation" in checks:
        checked = recompute(beads, atoms, frame, rules)
        if "pbc" in checks and "conservation" in checks:
            checked = cut_lineage(checked)
        if "pbc" in checks:
            parts.append(span_issues(checked, atoms, frame, span))
        if "conservation" in checks:
            parts.append(conservation_issues(checked, frame, force_tol, pe_tol))
    if "coverage" in checks:
        parts.append(coverage_issues(beads, atoms, frame))
    if "manual" in checks:
        manual = rule_issues(beads, frame, rules)
        if manual is not None:
            parts.append(manual)
    return reduce(DataFrame.unionByName, parts)


def bad_files(beads: DataFrame, atom_frames: DataFrame, file: str = "file") -> DataFrame:
    """(file, reason): files with NULL core columns or steps the dump does not have."""
    core = ("id", "type", "x", "y", "z", "fx", "fy", "fz", "n_atoms", "atom_indices", "timestep")
    gaps = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.isnan(c) if t in ("double", "float") else F.lit(False))
                                       for c, t in beads.dtypes if c in core])
    holes = beads.groupBy(file).agg(F.bool_or(gaps).alias("_bad")).where("_bad").select(
        file, F.lit("missing values in core columns").alias("reason"))
    steps = beads.where(F.col("timestep").isNotNull()).select(file, "timestep").distinct()
    lost = steps.join(atom_frames.select(file, "timestep").distinct(), [file, "timestep"], "left_anti").select(
        file, F.lit("steps not in the atom dump").alias("reason")).distinct()
    first = holes.unionByName(lost)
    return first.groupBy(file).agg(F.min("reason").alias("reason"))


def frame_rollup(beads: DataFrame, issues: DataFrame, frame: Sequence[str]) -> DataFrame:
    """Beads, covered atoms and issue counts per frame."""
    frame = list(frame)
    counts = beads.groupBy(*frame).agg(F.count(F.lit(1)).alias("n_beads"),
                                       F.sum(F.size("atom_indices")).alias("n_covered"))
    found = issues.groupBy(*frame).agg(
        F.count_if(F.col("severity") == "FAIL").alias("n_fail"), F.count_if(F.col("severity") == "WARN").alias("n_warn"),
        *[F.count_if(F.col("check") == c).alias(f"n_{c}") for c in ("pbc", "conservation", "coverage", "manual")])
    return counts.join(found, frame, "left").na.fill(0)


def file_rollup(frames: DataFrame, file: Sequence[str], bad: DataFrame | None = None) -> DataFrame:
    """Status per file: OK, FAIL or BAD."""
    out = frames.groupBy(*file).agg(
        F.count(F.lit(1)).alias("n_frames"), F.sum("n_beads").alias("n_beads"),
        F.sum("n_fail").alias("n_fail"), F.sum("n_warn").alias("n_warn"))
    out = out.withColumn("status", F.when(F.col("n_fail") > 0, "FAIL").otherwise("OK"))
    if bad is not None:
        out = out.join(bad, list(file), "full").withColumn(
            "status", F.when(F.col("reason").isNotNull(), "BAD").otherwise(F.col("status")))
    return out


def find_owners(beads: DataFrame, atoms: DataFrame, frame: Sequence[str], atom_ids: Sequence[int],
                threshold: float = 0.45) -> DataFrame:
    """The bead that holds each asked atom per frame, its members, and how many
    further beads hold it too; atoms without a bead have NULLs."""
    frame = list(frame)
    asked = atoms.where(F.col("id").isin([int(i) for i in atom_ids])).select(
        *frame, F.col("id").alias("atom_id"), "row_idx", *POSITION)
    held = beads.select(*frame, F.col("id").alias("cg_id"), F.col("type").alias("cg_type"), "atom_indices",
                        F.coalesce("manual_assignment", F.lit(False)).alias("manual"))
    uses = held.select("*", F.explode(F.array_distinct("atom_indices")).alias("row_idx")).withColumn(
        "row_idx", F.col("row_idx").cast("bigint"))
    hit = asked.join(uses, [*frame, "row_idx"], "left")
    # an asked atom in many beads: keep the first, count the rest, both combine map-side
    hit = hit.groupBy(*frame, "atom_id", "row_idx", *POSITION).agg(
        F.min(F.struct("cg_id", "cg_type", "manual", "atom_indices")).alias("_b"),
        F.greatest(F.count("cg_id") - 1, F.lit(0)).alias("n_extra"))
    hit = hit.select("*", "_b.*").drop("_b")
    places = ["m_" + p for p in POSITION]
    sib = hit.select(*frame, "atom_id", F.posexplode("atom_indices").alias("pos", "_r")).withColumn("_r", F.col("_r").cast("bigint"))
    sib = sib.join(atoms.select(*frame, F.col("row_idx").alias("_r"), F.col("id").alias("_sid"),
                                *[F.col(p).alias(m) for p, m in zip(POSITION, places)], *LENGTHS), [*frame, "_r"])
    sib = sib.groupBy(*frame, "atom_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "_sid"))), lambda s: s["_sid"]).alias("member_ids"),
        F.greatest(*[F.try_divide(F.max(m) - F.min(m), F.first(l)) for m, l in zip(places, LENGTHS)]).alias("span"))
    return hit.join(sib, [*frame, "atom_id"], "left").select(
        *frame, "atom_id", "row_idx", *POSITION, "cg_id", "cg_type", "manual", "member_ids",
        (~F.col("manual") & (F.size("member_ids") >= 2) & (F.col("span") > threshold)).alias("spans_box"), "n_extra")
