"""All registered queries."""
from __future__ import annotations

from trajlake.plans import audit_queries, bead_queries, dataset_queries, file_queries, index_queries, job_queries, structure_queries, training_queries

_BEADS = bead_queries
MEAN_FORCE = f"""WITH RECURSIVE {_BEADS.at.ATOMS_SQL}, {_BEADS.at.PAIRS_SQL}, {_BEADS.GREEDY_SQL}, {_BEADS.at.LABELS_SQL},
beads AS (SELECT m.frame, center_row, sum(fx * w) / sum(w) AS fx, sum(fy * w) / sum(w) AS fy, sum(fz * w) / sum(w) AS fz
  FROM members m JOIN (SELECT *, CASE type WHEN 1 THEN 12 ELSE 1 END::DOUBLE AS w FROM atoms) a
    ON a.frame = m.frame AND a.row_idx = m.row_idx GROUP BY m.frame, center_row)
SELECT sim_type, temp, count(*) AS n_beads, round(avg(sqrt(fx*fx + fy*fy + fz*fz)), 9) AS force_mean
FROM beads JOIN labels_of USING (frame) GROUP BY sim_type, temp"""

REGISTERED = {
    "mean_force_by_sim": (dataset_queries.mean_force_by_sim, MEAN_FORCE),
    **bead_queries.QUERIES,
    **dataset_queries.QUERIES,
    **audit_queries.QUERIES,
    **structure_queries.QUERIES,
    **file_queries.QUERIES,
    **job_queries.QUERIES,
    **index_queries.QUERIES,
    **training_queries.QUERIES,
}


def flagship(spark, sf_dir):
    return dataset_queries.mean_force_by_sim(spark, sf_dir)
