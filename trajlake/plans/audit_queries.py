"""Registered queries: bead audit against source atoms."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import round_to
from trajlake.operators import audit as A
from trajlake.operators.beads import BeadRules
from trajlake.operators.neighbors import with_position
from trajlake.plans import bindings as at
from trajlake.session import cut_lineage

RULES = BeadRules(cg_assignments=(((1, 2, 3), 2), ((4, 5, 6), 4), ((90, 91), 2)))


def _tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Atoms, and beads of three consecutive atoms with seeded defects."""
    atoms = cut_lineage(with_position(at.atoms(spark, sf_dir)))
    k = F.floor(F.col("row_idx") / 3)
    w = F.when(F.col("type") == 1, 12.0).otherwise(1.0)
    beads = (atoms.withColumns({"_k": k, "_w": w}).groupBy("frame", "_k").agg(
        F.count(F.lit(1)).alias("_n"), *[F.min_by(p, "row_idx").alias(c) for p, c in zip(("px", "py", "pz"), "xyz")],
        *[(F.sum(F.col(c) * F.col("_w")) / F.sum("_w")).alias(c) for c in ("fx", "fy", "fz")],
        F.avg("c_pe").alias("c_pe")).where(F.col("_n") == 3))
    mark = F.col("frame") + F.col("_k")
    rows = F.array(*[F.col("_k") * 3 + i for i in range(3)])
    ids = F.when(mark % 17 == 0, F.array()).when(
        mark % 13 == 0, F.array(F.col("_k") * 3, F.col("_k") * 3 + 1, F.col("_k") * 3 + 3)).otherwise(rows)
    beads = cut_lineage(beads.select(
        "frame", (F.col("_k") + 1).alias("id"), (F.col("_k") + F.when(mark % 19 == 0, 5).otherwise(2)).alias("type"), "x", "y", "z",
        (F.col("fx") + F.when(mark % 7 == 0, 1e-3).otherwise(0.0)).alias("fx"), "fy", "fz",
        (F.col("c_pe") + F.when(mark % 11 == 0, 1e-5).otherwise(0.0)).alias("c_pe"), ids.alias("atom_indices"),
        ((F.col("_k") < 2) & (mark % 23 != 0) | (mark % 29 == 0)).alias("manual_assignment"),
        F.transform(rows, lambda r: r + 1).alias("assigned_atom_ids")))  # every check reads them
    return atoms, beads


TABLES_SQL = f"""{at.ATOMS_SQL}, base AS (
  SELECT frame, row_idx // 3 AS k, arg_min(x, row_idx) AS x, arg_min(y, row_idx) AS y, arg_min(z, row_idx) AS z,
    sum(fx * w) / sum(w) AS fx, sum(fy * w) / sum(w) AS fy, sum(fz * w) / sum(w) AS fz, avg(c_pe) AS c_pe, frame + row_idx // 3 AS mark
  FROM (SELECT *, CASE type WHEN 1 THEN 12 ELSE 1 END::DOUBLE AS w FROM atoms) GROUP BY frame, row_idx // 3 HAVING count(*) = 3),
beads AS (
  SELECT frame, k + 1 AS id, k + CASE WHEN mark % 19 = 0 THEN 5 ELSE 2 END AS type, x, y, z,
    fx + CASE WHEN mark % 7 = 0 THEN 1e-3 ELSE 0e0 END AS fx, fy, fz, c_pe + CASE WHEN mark % 11 = 0 THEN 1e-5 ELSE 0e0 END AS c_pe,
    CASE WHEN mark % 17 = 0 THEN []::BIGINT[] WHEN mark % 13 = 0 THEN [3*k, 3*k+1, 3*k+3] ELSE [3*k, 3*k+1, 3*k+2] END AS atom_indices,
    ((k < 2 AND mark % 23 <> 0) OR mark % 29 = 0) AS manual_assignment, [3*k+1, 3*k+2, 3*k+3] AS assigned_atom_ids FROM base),
uses AS (SELECT frame, id AS cg_id, unnest(atom_indices) AS row_idx, generate_subscripts(atom_indices, 1) - 1 AS pos FROM beads),
members AS (
  SELECT u.frame, u.cg_id, u.pos, a.* EXCLUDE (frame), CASE type WHEN 1 THEN 12 WHEN 2 THEN 1 END::DOUBLE AS w
  FROM uses u LEFT JOIN atoms a ON a.frame = u.frame AND a.row_idx = u.row_idx),
per_bead AS (
  SELECT frame, cg_id, count(*) AS n_members, count(*) - count(row_idx) AS n_lost, arg_min(x, pos) AS ex, arg_min(y, pos) AS ey,
    arg_min(z, pos) AS ez, sum(fx * w) / sum(w) AS efx, sum(fy * w) / sum(w) AS efy, sum(fz * w) / sum(w) AS efz, avg(c_pe) AS epe,
    (max(x) - min(x)) / 50 AS sx, (max(y) - min(y)) / 12 AS sy, (max(z) - min(z)) / 10 AS sz,
    string_agg(id::VARCHAR, ';' ORDER BY pos) AS member_atom_ids
  FROM members GROUP BY frame, cg_id),
checked AS (
  SELECT b.*, n_members, n_lost, sx, sy, sz, member_atom_ids, greatest(abs(ex - x), abs(ey - y), abs(ez - z)) AS pos_err,
    greatest(abs(efx - fx), abs(efy - fy), abs(efz - fz)) AS force_err, abs(epe - c_pe) AS pe_err
  FROM beads b LEFT JOIN per_bead p ON p.frame = b.frame AND p.cg_id = b.id)"""


def audit_conservation(spark, sf_dir) -> DataFrame:
    atoms, beads = _tables(spark, sf_dir)
    out = A.conservation_issues(A.recompute(beads, atoms, at.FRAME, RULES), at.FRAME)
    return out.select("frame", "cg_id", F.substring_index("message", ":", 1).alias("message"), "n_atoms",
                      *[round_to(F.col(c), 9).alias(c) for c in ("force_err", "pe_err", "pos_err")])


AUDIT_CONSERVATION = f"""WITH {TABLES_SQL}
SELECT frame, id AS cg_id, CASE WHEN n_members IS NULL THEN 'bead without members' WHEN n_lost > 0 THEN 'member outside the frame'
    ELSE 'stored values differ' END AS message,
  CASE WHEN n_lost = 0 THEN n_members END AS n_atoms, CASE WHEN n_lost = 0 THEN round(force_err, 9) END AS force_err,
  CASE WHEN n_lost = 0 THEN round(pe_err, 9) END AS pe_err, CASE WHEN n_lost = 0 THEN round(pos_err, 9) END AS pos_err
FROM checked WHERE n_members IS NULL OR n_lost > 0 OR pos_err > 1e-9 OR force_err > 1e-4 OR pe_err > 1e-6"""


def audit_span(spark, sf_dir) -> DataFrame:
    atoms, beads = _tables(spark, sf_dir)
    out = A.span_issues(A.recompute(beads, atoms, at.FRAME, RULES), atoms, at.FRAME)
    return out.select("frame", "cg_id", "severity", F.substring("message", -1, 1).alias("axis"), "member_atom_ids",
                      *[round_to(F.col(f"pbc_span_frac_{a}"), 9).alias(f"span_{a}") for a in "xyz"])


AUDIT_SPAN = f"""WITH {TABLES_SQL}, s AS (SELECT *, greatest(sx, sy, sz) AS worst FROM checked
  WHERE NOT manual_assignment AND n_members >= 2 AND n_lost = 0)
SELECT frame, id AS cg_id, CASE WHEN worst > 0.45::DOUBLE THEN 'FAIL' ELSE 'WARN' END AS severity,
  CASE WHEN sx = worst THEN 'x' WHEN sy = worst THEN 'y' ELSE 'z' END AS axis,
  CASE WHEN worst > 0.45::DOUBLE THEN member_atom_ids END AS member_atom_ids, round(sx, 9) AS span_x, round(sy, 9) AS span_y, round(sz, 9) AS span_z
FROM s WHERE worst > 0.225::DOUBLE"""


def audit_coverage(spark, sf_dir) -> DataFrame:
    atoms, beads = _tables(spark, sf_dir)
    return A.coverage_atoms(beads, atoms, at.FRAME)


COVERAGE_SQL = """n AS (SELECT frame, row_idx, count(*) AS n FROM uses GROUP BY frame, row_idx),
j AS (SELECT coalesce(a.frame, n.frame) AS frame, coalesce(a.row_idx, n.row_idx) AS row_idx, a.id, coalesce(n.n, 0) AS n
  FROM (SELECT * FROM atoms SEMI JOIN beads USING (frame)) a FULL JOIN n ON n.frame = a.frame AND n.row_idx = a.row_idx)"""
AUDIT_COVERAGE = f"WITH {TABLES_SQL}, {COVERAGE_SQL} SELECT frame, row_idx, id AS atom_id, n AS uses FROM j WHERE n <> 1"


def audit_frame_coverage(spark, sf_dir) -> DataFrame:
    atoms, beads = _tables(spark, sf_dir)
    return A.coverage_issues(beads, atoms, at.FRAME).select("frame", "message", "n_atoms")


AUDIT_FRAME_COVERAGE = f"""WITH {TABLES_SQL}, {COVERAGE_SQL},
k AS (SELECT frame, count(*) FILTER (n = 0) AS missing, count(*) FILTER (n > 1) AS doubled, sum(n)::BIGINT AS seen, count(id) AS atoms
  FROM j GROUP BY frame)
SELECT frame, 'atoms in no bead' AS message, missing AS n_atoms FROM k WHERE missing > 0
UNION ALL SELECT frame, 'atoms in several beads', doubled FROM k WHERE doubled > 0
UNION ALL SELECT frame, 'members and atoms differ in number', seen - atoms FROM k WHERE missing = 0 AND doubled = 0 AND seen <> atoms"""


def audit_rules(spark, sf_dir) -> DataFrame:
    _, beads = _tables(spark, sf_dir)
    out = A.rule_issues(beads, at.FRAME, RULES)
    return out.select("frame", "severity", "cg_id", "message")


AUDIT_RULES = f"""WITH {TABLES_SQL}, d AS (
  SELECT * FROM (SELECT DISTINCT frame FROM beads), (VALUES ([1,2,3]::BIGINT[], 2), ([4,5,6]::BIGINT[], 4), ([90,91]::BIGINT[], 2)) v(ids, want)),
m AS (SELECT frame, assigned_atom_ids AS ids, count(*) AS n, min(type) AS type, min(id) AS id FROM beads WHERE manual_assignment GROUP BY ALL),
j AS (SELECT coalesce(d.frame, m.frame) AS frame, coalesce(d.ids, m.ids) AS ids, want, n, type, id
  FROM d FULL JOIN m ON d.frame = m.frame AND d.ids = m.ids),
k AS (SELECT *, CASE WHEN want IS NULL THEN 'marked manual without a rule' WHEN n IS NULL THEN 'rule without a bead'
  WHEN n > 1 THEN 'several beads of one rule' WHEN type <> want THEN 'bead of another type than its rule' END AS kind FROM j)
SELECT frame, CASE WHEN want IS NULL THEN 'WARN' ELSE 'FAIL' END AS severity, CASE WHEN kind = 'bead of another type than its rule' THEN id END AS cg_id,
  kind || ': ' || array_to_string(ids, ',') AS message FROM k WHERE kind IS NOT NULL"""


def audit_summary(spark, sf_dir) -> DataFrame:
    """Frames by status and check."""
    atoms, beads = _tables(spark, sf_dir)
    issues = A.audit_issues(beads, atoms, at.FRAME, RULES)
    frames = A.frame_rollup(beads, issues, at.FRAME)
    return frames.groupBy(F.when(F.col("n_fail") > 0, "FAIL").otherwise("OK").alias("status")).agg(
        F.count(F.lit(1)).alias("n_frames"), *[F.sum(c).alias(c) for c in (
            "n_beads", "n_covered", "n_fail", "n_warn", "n_pbc", "n_conservation", "n_coverage", "n_manual")])


AUDIT_SUMMARY = f"""WITH c AS ({AUDIT_CONSERVATION}), s AS ({AUDIT_SPAN}), v AS ({AUDIT_FRAME_COVERAGE}), r AS ({AUDIT_RULES}), {TABLES_SQL},
i AS (SELECT frame, 'FAIL' AS severity, 'conservation' AS chk FROM c UNION ALL SELECT frame, severity, 'pbc' FROM s
  UNION ALL SELECT frame, 'FAIL', 'coverage' FROM v UNION ALL SELECT frame, severity, 'manual' FROM r),
n AS (SELECT frame, count(*) FILTER (severity = 'FAIL') AS n_fail, count(*) FILTER (severity = 'WARN') AS n_warn,
    count(*) FILTER (chk = 'pbc') AS n_pbc, count(*) FILTER (chk = 'conservation') AS n_conservation, count(*) FILTER (chk = 'coverage') AS n_coverage,
    count(*) FILTER (chk = 'manual') AS n_manual
  FROM i GROUP BY frame),
f AS (SELECT frame, count(*) AS n_beads, sum(len(atom_indices)) AS n_covered FROM beads GROUP BY frame)
SELECT CASE WHEN n_fail > 0 THEN 'FAIL' ELSE 'OK' END AS status, count(*) AS n_frames, sum(n_beads)::BIGINT AS n_beads,
  sum(n_covered)::BIGINT AS n_covered, coalesce(sum(n_fail), 0)::BIGINT AS n_fail, coalesce(sum(n_warn), 0)::BIGINT AS n_warn,
  coalesce(sum(n_pbc), 0)::BIGINT AS n_pbc, coalesce(sum(n_conservation), 0)::BIGINT AS n_conservation,
  coalesce(sum(n_coverage), 0)::BIGINT AS n_coverage, coalesce(sum(n_manual), 0)::BIGINT AS n_manual
FROM f LEFT JOIN n USING (frame) GROUP BY 1"""


def atom_owner(spark, sf_dir) -> DataFrame:
    atoms, beads = _tables(spark, sf_dir)
    out = A.find_owners(beads, atoms, at.FRAME, [2, 4, 6])
    return out.select(
        "frame", "atom_id", "row_idx", "cg_id", F.col("cg_type").cast("bigint").alias("cg_type"), "manual",
        F.array_join(F.transform("member_ids", lambda v: v.cast("string")), ",").alias("member_ids"), "spans_box", "n_extra")


ATOM_OWNER = f"""WITH {TABLES_SQL}, o AS (
  SELECT a.frame, a.id AS atom_id, a.row_idx, min(u.cg_id) AS cg_id, greatest(count(DISTINCT u.cg_id) - 1, 0) AS n_extra
  FROM atoms a LEFT JOIN uses u ON u.frame = a.frame AND u.row_idx = a.row_idx WHERE a.id IN (2, 4, 6) GROUP BY ALL),
s AS (SELECT frame, cg_id, string_agg(id::VARCHAR, ',' ORDER BY pos) AS member_ids, count(row_idx) AS n, (max(x) - min(x)) / 50 AS sx,
    (max(y) - min(y)) / 12 AS sy, (max(z) - min(z)) / 10 AS sz FROM members GROUP BY frame, cg_id)
SELECT o.frame, atom_id, o.row_idx, o.cg_id, b.type::BIGINT AS cg_type, b.manual_assignment AS manual, member_ids,
  NOT b.manual_assignment AND s.n >= 2 AND greatest(sx, sy, sz) > 0.45::DOUBLE AS spans_box, n_extra
FROM o LEFT JOIN beads b ON b.frame = o.frame AND b.id = o.cg_id LEFT JOIN s ON s.frame = o.frame AND s.cg_id = o.cg_id"""

QUERIES = {
    "audit_conservation": (audit_conservation, AUDIT_CONSERVATION),
    "audit_span": (audit_span, AUDIT_SPAN),
    "audit_coverage": (audit_coverage, AUDIT_COVERAGE),
    "audit_frame_coverage": (audit_frame_coverage, AUDIT_FRAME_COVERAGE),
    "audit_rules": (audit_rules, AUDIT_RULES),
    "audit_summary": (audit_summary, AUDIT_SUMMARY),
    "atom_owner": (atom_owner, ATOM_OWNER),
}
