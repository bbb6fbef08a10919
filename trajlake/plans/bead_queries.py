"""Registered queries: unwrapping, neighbours, bead assignment."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import round_to
from trajlake.operators import beads as B
from trajlake.operators.neighbors import candidate_pairs, nearest_members, with_position
from trajlake.operators.unwrap import unwrap_chain
from trajlake.plans import bindings as at
from trajlake.session import cut_lineage

CUTOFF = 6.0
PATTERNS = ((1, 2, 2), (1, 2))
OFFSETS = ((1, 2, 2), (0, 1, 2), 3)
EXPLICIT_IDS = (((1, 2, 3), 2), ((3, 4), 5), ((5, 6, 7), 2))


def _atoms(spark, sf_dir):
    return with_position(at.atoms(spark, sf_dir))


def _kept_atoms(spark, sf_dir):
    """Atoms that several steps of a query read; built once."""
    return cut_lineage(_atoms(spark, sf_dir))


def chain_unwrap(spark, sf_dir) -> DataFrame:
    out = unwrap_chain(at.atoms(spark, sf_dir), at.FRAME)
    return out.select("frame", "row_idx", *[round_to(F.col(c), 9).alias(c) for c in "xyz"])


CHAIN_UNWRAP = f"""WITH {at.ATOMS_SQL}, d AS (
  SELECT *, coalesce(round_even((x - lag(x) OVER w) / lx, 0), 0) AS dx,
    coalesce(round_even((y - lag(y) OVER w) / ly, 0), 0) AS dy, coalesce(round_even((z - lag(z) OVER w) / lz, 0), 0) AS dz
  FROM atoms WINDOW w AS (PARTITION BY frame ORDER BY id, row_idx))
SELECT frame, row_idx, round(x - sum(dx::DOUBLE) OVER w * lx, 9) AS x, round(y - sum(dy::DOUBLE) OVER w * ly, 9) AS y,
  round(z - sum(dz::DOUBLE) OVER w * lz, 9) AS z
FROM d WINDOW w AS (PARTITION BY frame ORDER BY id, row_idx ROWS UNBOUNDED PRECEDING)"""


def neighbor_candidates(spark, sf_dir) -> DataFrame:
    pairs = candidate_pairs(_atoms(spark, sf_dir), at.FRAME, CUTOFF)
    return pairs.select("frame", "center_row", "member_row", round_to("d2", 9).alias("d2"))


NEIGHBOR_CANDIDATES = f"""WITH {at.ATOMS_SQL}, {at.PAIRS_SQL}
SELECT frame, center_row, member_row, round(d2, 9) AS d2 FROM pairs"""


def nearest_two(spark, sf_dir) -> DataFrame:
    out = nearest_members(_atoms(spark, sf_dir), at.FRAME, CUTOFF, 2)
    return out.select("frame", "center_row", "member_row", F.col("rank").cast("bigint").alias("rank"),
                      round_to("d2", 9).alias("d2"))


NEAREST_TWO = f"""WITH {at.ATOMS_SQL}, {at.PAIRS_SQL}
SELECT frame, center_row, member_row, rank, round(d2, 9) AS d2 FROM (
  SELECT *, row_number() OVER (PARTITION BY frame, center_row ORDER BY d2, member_row) AS rank FROM pairs)
WHERE rank <= 2"""


def _bead_columns(beads: DataFrame) -> DataFrame:
    return beads.select(
        "frame", F.col("id").cast("bigint").alias("id"), F.col("type").cast("bigint").alias("type"),
        *[round_to(F.col(c), 9).alias(c) for c in ("x", "y", "z", "fx", "fy", "fz", "c_pe")],
        F.col("n_atoms").cast("bigint").alias("n_atoms"),
        F.array_join(F.transform("atom_indices", lambda i: i.cast("string")), ",").alias("atom_indices"))


# members(frame, stage order, center_row, cg_type, pos, row_idx) -> the columns above
BEAD_VALUES_SQL = """SELECT frame, row_number() OVER (PARTITION BY frame ORDER BY rule_no, center_row) AS id, type,
  round(x, 9) AS x, round(y, 9) AS y, round(z, 9) AS z, round(fx, 9) AS fx, round(fy, 9) AS fy, round(fz, 9) AS fz,
  round(c_pe, 9) AS c_pe, n_atoms, atom_indices
FROM (SELECT m.frame, rule_no, center_row, any_value(cg_type)::BIGINT AS type, arg_min(x, pos) AS x, arg_min(y, pos) AS y,
    arg_min(z, pos) AS z, sum(fx * w) / sum(w) AS fx, sum(fy * w) / sum(w) AS fy, sum(fz * w) / sum(w) AS fz,
    avg(c_pe) AS c_pe, count(*) AS n_atoms, string_agg(m.row_idx::VARCHAR, ',' ORDER BY pos) AS atom_indices
  FROM members m JOIN (SELECT *, CASE type WHEN 1 THEN 12 WHEN 2 THEN 1 END::DOUBLE AS w FROM atoms) a
    ON a.frame = m.frame AND a.row_idx = m.row_idx
  GROUP BY m.frame, rule_no, center_row)"""


def bead_fast_path(spark, sf_dir) -> DataFrame:
    """Beads of the centers nobody competes with."""
    atoms = _kept_atoms(spark, sf_dir)
    rules = B.BeadRules(patterns=PATTERNS, r_cutoff=CUTOFF)
    flagged = B.flag_contested(candidate_pairs(atoms, at.FRAME, CUTOFF), at.FRAME)
    members = B.settle_uncontested(flagged, at.FRAME, rules)
    return _bead_columns(B.build_beads(members, atoms, at.FRAME, rules))


BEAD_FAST_PATH = f"""WITH {at.ATOMS_SQL}, {at.PAIRS_SQL}, claims AS (
  SELECT *, count(*) OVER (PARTITION BY frame, member_row) AS n FROM pairs),
ranked AS (
  SELECT *, max(n) OVER (PARTITION BY frame, center_row) AS worst, count(*) OVER (PARTITION BY frame, center_row) AS c,
    row_number() OVER (PARTITION BY frame, center_row ORDER BY d2, member_row) AS rank FROM claims),
members AS (
  SELECT frame, 0 AS rule_no, center_row, CASE WHEN c >= 2 THEN 1 ELSE 2 END AS cg_type, rank AS pos, member_row AS row_idx
  FROM ranked WHERE worst = 1 AND rank <= CASE WHEN c >= 2 THEN 2 ELSE 1 END
  UNION ALL
  SELECT frame, 0, center_row, CASE WHEN c >= 2 THEN 1 ELSE 2 END, 0, center_row FROM ranked WHERE worst = 1 AND rank = 1)
{BEAD_VALUES_SQL}"""


def bead_greedy(spark, sf_dir) -> DataFrame:
    """The whole nearest-neighbour stage, competing centers included."""
    atoms = _kept_atoms(spark, sf_dir)
    rules = B.BeadRules(patterns=PATTERNS, r_cutoff=CUTOFF)
    members = B.distance_members(atoms, at.FRAME, rules)
    return _bead_columns(B.build_beads(members, atoms, at.FRAME, rules))


GREEDY_SQL = """lists AS (
  SELECT frame, center_row, list(member_row ORDER BY d2, member_row) AS cand,
    row_number() OVER (PARTITION BY frame ORDER BY center_row) AS k
  FROM pairs GROUP BY frame, center_row),
greedy AS (
  SELECT frame, k, center_row, list_filter(cand, lambda m: true)[1:2] AS got, list_filter(cand, lambda m: true)[1:2] AS used
  FROM lists WHERE k = 1
  UNION ALL
  SELECT frame, k, center_row, got, list_concat(used, got) AS used FROM (
    SELECT l.frame, l.k, l.center_row, g.used, list_filter(l.cand, lambda m: NOT list_contains(g.used, m))[1:2] AS got
    FROM greedy g JOIN lists l ON l.frame = g.frame AND l.k = g.k + 1)),
members AS (
  SELECT frame, 0 AS rule_no, center_row, CASE WHEN len(got) = 2 THEN 1 ELSE 2 END AS cg_type, 0 AS pos, center_row AS row_idx
  FROM greedy WHERE len(got) > 0
  UNION ALL
  SELECT frame, 0, center_row, CASE WHEN len(got) = 2 THEN 1 ELSE 2 END, generate_subscripts(got, 1), unnest(got)
  FROM greedy WHERE len(got) > 0)"""

BEAD_GREEDY = f"WITH RECURSIVE {at.ATOMS_SQL}, {at.PAIRS_SQL}, {GREEDY_SQL}\n{BEAD_VALUES_SQL}"


def bead_unlimited(spark, sf_dir) -> DataFrame:
    """The nearest-neighbour stage without a cutoff."""
    atoms = _kept_atoms(spark, sf_dir)
    rules = B.BeadRules(patterns=PATTERNS)
    members = B.distance_members(atoms, at.FRAME, rules)
    return _bead_columns(B.build_beads(members, atoms, at.FRAME, rules))


BEAD_UNLIMITED = BEAD_GREEDY.replace("WHERE d2 <= 36)", ")")


def bead_by_id_offset(spark, sf_dir) -> DataFrame:
    atoms = _kept_atoms(spark, sf_dir)
    rules = B.BeadRules(id_patterns=(OFFSETS,))
    members, _ = B.offset_members(atoms, at.FRAME, rules.valid_id_patterns()[0], 1)
    return _bead_columns(B.build_beads(members, atoms, at.FRAME, rules))


BEAD_BY_ID_OFFSET = f"""WITH {at.ATOMS_SQL}, members AS (
  SELECT c.frame, 0 AS rule_no, c.row_idx AS center_row, 3 AS cg_type, o AS pos, c.row_idx + o AS row_idx
  FROM atoms c JOIN atoms a ON a.frame = c.frame AND a.id = c.id + 1 AND a.type = 2
    JOIN atoms b ON b.frame = c.frame AND b.id = c.id + 2 AND b.type = 2, range(3) r(o)
  WHERE c.type = 1)
{BEAD_VALUES_SQL}"""


def bead_by_explicit_ids(spark, sf_dir) -> DataFrame:
    """Three id lists; the second shares an atom with the first."""
    atoms = _atoms(spark, sf_dir)
    rules = B.BeadRules(cg_assignments=EXPLICIT_IDS)
    members = B.explicit_members(atoms, at.FRAME, rules)
    return _bead_columns(B.build_beads(members, atoms, at.FRAME, rules))


# ids run 1..n, so the first list is in every frame; the second list loses its frames to it
BEAD_BY_EXPLICIT_IDS = f"""WITH {at.ATOMS_SQL}, members AS (
  SELECT frame, CASE WHEN id <= 3 THEN 0 ELSE 2 END AS rule_no,
    min(row_idx) OVER (PARTITION BY frame, id <= 3) AS center_row, 2 AS cg_type,
    row_number() OVER (PARTITION BY frame, id <= 3 ORDER BY row_idx) - 1 AS pos, row_idx
  FROM atoms WHERE id IN (1, 2, 3, 5, 6, 7))
{BEAD_VALUES_SQL}"""

COARSE_RULES = B.BeadRules(patterns=PATTERNS, r_cutoff=CUTOFF, cg_assignments=(((1, 2), 9),),
                           id_patterns=(((1, 2, 2), (0, 1, 2), 3),), unwrap_pbc=True)


def coarse_grain(spark, sf_dir) -> DataFrame:
    """All three stages on unwrapped chains."""
    atoms = cut_lineage(with_position(unwrap_chain(at.atoms(spark, sf_dir), at.FRAME)))
    members, _ = B.assign_members(atoms, at.FRAME, COARSE_RULES)
    return _bead_columns(B.build_beads(members, atoms, at.FRAME, COARSE_RULES))


# ids run 1..n and every third atom is a center: the id list takes rows 0 and 1, complete groups of
# three are bound by offsets, and at most one center per frame is left for the distance stage
COARSE_SQL = """sized AS (SELECT *, count(*) OVER (PARTITION BY frame) AS n FROM {source}),
open AS (SELECT * FROM sized WHERE type = 1 AND row_idx >= 3 AND row_idx + 2 >= n),
reach AS (
  SELECT *, row_number() OVER (PARTITION BY frame ORDER BY d2, row_idx) AS pos, count(*) OVER (PARTITION BY frame) AS c FROM (
    SELECT c.frame, c.row_idx AS center_row, m.row_idx,
      pow((m.x-c.x) - round_even((m.x-c.x)/c.lx,0)*c.lx, 2) + pow((m.y-c.y) - round_even((m.y-c.y)/c.ly,0)*c.ly, 2)
      + pow((m.z-c.z) - round_even((m.z-c.z)/c.lz,0)*c.lz, 2) AS d2
    FROM open c JOIN sized m ON m.frame = c.frame AND m.type = 2 AND (m.row_idx = 2 OR m.row_idx > c.row_idx))
  WHERE d2 <= 36)"""
COARSE_GRAIN = f"""WITH {at.ATOMS_SQL}, d AS (
  SELECT *, coalesce(round_even((x - lag(x) OVER w) / lx, 0), 0) AS dx,
    coalesce(round_even((y - lag(y) OVER w) / ly, 0), 0) AS dy, coalesce(round_even((z - lag(z) OVER w) / lz, 0), 0) AS dz
  FROM atoms WINDOW w AS (PARTITION BY frame ORDER BY id)),
moved AS (
  SELECT frame, row_idx, id, type, fx, fy, fz, c_pe, lx, ly, lz, x - sum(dx::DOUBLE) OVER w * lx AS x, y - sum(dy::DOUBLE) OVER w * ly AS y,
    z - sum(dz::DOUBLE) OVER w * lz AS z FROM d WINDOW w AS (PARTITION BY frame ORDER BY id ROWS UNBOUNDED PRECEDING)),
{COARSE_SQL.format(source='moved')},
members AS (
  SELECT frame, 1 AS rule_no, 0 AS center_row, 9 AS cg_type, row_idx AS pos, row_idx FROM sized WHERE row_idx < 2
  UNION ALL
  SELECT frame, 2, row_idx, 3, o, row_idx + o FROM sized, range(3) r(o) WHERE type = 1 AND row_idx >= 3 AND row_idx + 2 < n
  UNION ALL
  SELECT frame, 3, center_row, CASE WHEN c >= 2 THEN 1 ELSE 2 END, pos, row_idx FROM reach WHERE pos <= 2
  UNION ALL
  SELECT frame, 3, center_row, CASE WHEN c >= 2 THEN 1 ELSE 2 END, 0, center_row FROM reach WHERE pos = 1)
{BEAD_VALUES_SQL.replace("FROM atoms)", "FROM moved)")}"""


def bead_warnings(spark, sf_dir) -> DataFrame:
    """Centers left out, rolled up by stage and reason."""
    atoms = _kept_atoms(spark, sf_dir)
    _, notes = B.assign_members(atoms, at.FRAME, COARSE_RULES)
    return notes.groupBy(F.col("stage").cast("bigint").alias("stage"), "reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("frame").alias("first_frame"))


BEAD_WARNINGS = f"""WITH {at.ATOMS_SQL}, {COARSE_SQL.format(source='atoms')}
SELECT 2 AS stage, 'missing' AS reason, count(*) AS n, min(frame) AS first_frame FROM open
UNION ALL
SELECT 3, 'no pattern', count(*), min(frame) FROM open WHERE frame NOT IN (SELECT frame FROM reach)"""

QUERIES = {
    "chain_unwrap": (chain_unwrap, CHAIN_UNWRAP),
    "neighbor_candidates": (neighbor_candidates, NEIGHBOR_CANDIDATES),
    "nearest_two": (nearest_two, NEAREST_TWO),
    "bead_fast_path": (bead_fast_path, BEAD_FAST_PATH),
    "bead_greedy": (bead_greedy, BEAD_GREEDY),
    "bead_unlimited": (bead_unlimited, BEAD_UNLIMITED),
    "bead_by_id_offset": (bead_by_id_offset, BEAD_BY_ID_OFFSET),
    "bead_by_explicit_ids": (bead_by_explicit_ids, BEAD_BY_EXPLICIT_IDS),
    "coarse_grain": (coarse_grain, COARSE_GRAIN),
    "bead_warnings": (bead_warnings, BEAD_WARNINGS),
}
