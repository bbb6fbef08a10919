"""Registered queries on training files: sets, labels and predictions are written and read back."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import cell9, round_to
from trajlake.plans import bindings as at
from trajlake.plans.checks import score_predictions
from trajlake.plans.file_queries import _name, write_logs
from trajlake.plans.training_sets import labels_for_boxes, measured_labels, training_rows, write_labels, write_sets, write_text, write_type_lines
from trajlake.session import cut_lineage, shared_folder, stored, tidy
from trajlake.sinks.training import QUANTITIES, write_npy, write_raw
from trajlake.sources.matrix import read_npy, read_raw

# electron volts in a kelvin (fixed value)
EV = "8.617333262e-5"
PLACE = r"/([^/]+)/([^/]+)/n(\d+)/set\.(\d+)/([^/]*)\.npy$"


def _total(values: str = "values"):
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def npy_round_trip(spark, sf_dir) -> DataFrame:
    """Descriptor rows in one array file per label, read back by byte ranges."""
    rows = at.descriptors(spark, sf_dir)
    folder = shared_folder(rows)
    write_npy(rows, folder, "features", F.concat(F.lit("sim="), "label"), ["id"], "features", ["id"])
    back = read_npy(spark, f"{folder}/sim=*/features.npy")
    return back.select(_name().cast("bigint").alias("label"), "frame_no", F.size("values").cast("bigint").alias("width"),
                       F.col("values")[0].alias("first"), F.col("values")[63].alias("last"), round_to(_total(), 6).alias("total"))


NPY_ROUND_TRIP = """SELECT label::BIGINT AS label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_no, 64::BIGINT AS width,
  embedding[1]::DOUBLE AS first, embedding[64]::DOUBLE AS last, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings"""


# quantities whose array files lie on disk together: those of one sort, about half of all values each
TOGETHER = (("coord", "energy", "box"), ("force", "atom_ener"))


def training_files(spark, sf_dir) -> DataFrame:
    """Training sets written as array and text files: totals of every set (text: set -1) as read back.

    The files are scratch: each kind goes when its totals are stored, so that the whole set never lies on disk.
    """
    sets = stored(spark, lambda: _training_rows(spark, sf_dir))
    with tidy(spark):
        write_type_lines(sets, shared_folder(sets))
    totals = [stored(spark, lambda: _set_totals(sets, names)) for names in TOGETHER]
    totals += [stored(spark, lambda: _text_totals(sets, name)) for name in QUANTITIES]
    # a text folder may hold several part files
    return reduce(DataFrame.unionByName, totals).groupBy("sim_type", "temp", "n_beads", "set_id", "quantity").agg(
        F.sum("n").alias("n_frames"), F.sum("m").alias("n_values"), round_to(F.sum("s"), 6).alias("total")).select(
        "sim_type", "temp", "n_beads", "set_id", "n_frames", "n_values", "total", "quantity")


def _training_rows(spark, sf_dir) -> DataFrame:
    rows = at.atoms(spark, sf_dir, labels=True).withColumns({
        "file": F.concat(F.lit("dump."), F.col("frame") % 50), "frame_idx": F.col("frame")})
    boxes = rows.select("file", "frame_idx", "lx", "ly", "lz").distinct().select(
        "file", "frame_idx", cell9(F.col("lx"), F.col("ly"), F.col("lz")).alias("cell"))
    return training_rows(rows, boxes, 3)


def _per_file(values: DataFrame) -> DataFrame:
    return values.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("values")).alias("m"), F.sum(_total()).alias("s"))


def _set_totals(sets: DataFrame, names: Sequence[str]) -> DataFrame:
    folder = shared_folder(sets)
    write_sets(sets, folder, names)
    place = [F.regexp_extract("file", PLACE, i) for i in range(1, 6)]
    return _per_file(read_npy(sets.sparkSession, [f"{folder}/*/*/*/set.*/{name}.npy" for name in names])).select(
        place[0].alias("sim_type"), *[p.cast("bigint").alias(c) for p, c in zip(place[1:4], ("temp", "n_beads", "set_id"))],
        place[4].alias("quantity"), "n", "m", "s")


def _text_totals(sets: DataFrame, name: str) -> DataFrame:
    folder = shared_folder(sets)
    write_text(sets, folder, name)
    plain = F.url_decode("file")
    return _per_file(read_raw(sets.sparkSession, f"{folder}/{name}.raw/*/*/*")).select(
        F.regexp_extract(plain, "sim_type=([^/]*)/", 1).alias("sim_type"), F.regexp_extract(plain, r"/temp=(\d+)/", 1).cast("bigint").alias("temp"),
        F.regexp_extract(plain, r"/n_beads=(\d+)/", 1).cast("bigint").alias("n_beads"), F.lit(-1).cast("bigint").alias("set_id"),
        F.lit(name).alias("quantity"), "n", "m", "s")


TRAINING_FILES = f"""WITH {at.ATOMS_SQL}, {at.LABELS_SQL},
f AS (SELECT frame, count(*) AS n_beads, sum(c_pe) AS e, sum(x + y + z) AS c, sum(fx + fy + fz) AS g FROM atoms GROUP BY frame),
s AS (SELECT f.*, sim_type, temp, ntile(3) OVER (PARTITION BY sim_type, temp, n_beads ORDER BY frame % 50, frame) - 1 AS set_id
  FROM f JOIN labels_of USING (frame)),
v AS (SELECT * FROM s UNION ALL SELECT * REPLACE (-1 AS set_id) FROM s),
q AS (SELECT sim_type, temp, n_beads, set_id, unnest([{{'q': 'coord', 'n': 3 * n_beads, 'v': c}}, {{'q': 'force', 'n': 3 * n_beads, 'v': g}},
  {{'q': 'atom_ener', 'n': n_beads, 'v': e}}, {{'q': 'energy', 'n': 1, 'v': e}}, {{'q': 'box', 'n': 9, 'v': 72}}]) AS u FROM v)
SELECT sim_type, temp, n_beads, set_id, count(*) AS n_frames, sum(u.n)::BIGINT AS n_values, round(sum(u.v), 6) AS total, u.q AS quantity
FROM q GROUP BY sim_type, temp, n_beads, set_id, u.q"""


def measured_label_files(spark, sf_dir) -> DataFrame:
    """Temperature labels of thermo logs, written and read back as array and as text."""
    folder = shared_folder(at.thermo(spark, sf_dir))
    labels = measured_labels(spark, write_logs(at.thermo(spark, sf_dir)))
    write_labels(labels.withColumn("sim", _name()), folder, ["sim"], ["block_id", "first_line"])
    arrays = read_npy(spark, f"{folder}/*/set.000/fparam.npy").select(
        F.regexp_extract("file", "/([^/]*)/set.000/", 1).alias("sim"), "frame_no", round_to(F.col("values")[0], 9).alias("fparam"))
    texts = read_raw(spark, f"{folder}/fparam.raw/sim=*").groupBy(_name().alias("sim")).agg(
        F.count(F.lit(1)).alias("n_text"), round_to(F.sum(_total()), 6).alias("text_total"))
    return arrays.join(texts, "sim")


MEASURED_LABEL_FILES = f"""WITH {at.THERMO_SQL},
t AS (SELECT sim, block_id, min(line_no) AS first_line, arg_max(temp, line_no) * {EV} AS v FROM thermo GROUP BY sim, block_id, step)
SELECT sim, row_number() OVER (PARTITION BY sim ORDER BY block_id, first_line) - 1 AS frame_no, round(v, 9) AS fparam,
  count(*) OVER (PARTITION BY sim) AS n_text, round(sum(v) OVER (PARTITION BY sim), 6) AS text_total FROM t"""


def box_label_files(spark, sf_dir) -> DataFrame:
    """A constant temperature label for every line of box files."""
    rows = at.frame_labels(spark, sf_dir).select("frame", F.substring("sim_type", 1, 1).alias("sim"), F.array(F.col("temp").cast("double")).alias("cell"))
    folder = shared_folder(rows)
    write_raw(rows, folder, ["sim"], ["frame"], "cell")
    labels = labels_for_boxes(spark, f"{folder}/sim=*", 320.0).groupBy(_name().alias("sim"), "file").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("frame_no").alias("n_places"), F.max("frame_no").alias("last"), F.avg("fparam").alias("v"))
    # a simulation may lie in several part files
    return labels.groupBy("sim").agg(F.sum("n").alias("n_frames"), F.sum("n_places").alias("n_places"), F.sum(F.col("last") + 1).alias("n_last"),
                                     round_to(F.avg("v"), 9).alias("fparam"))


BOX_LABEL_FILES = f"""WITH {at.LABELS_SQL} SELECT substr(sim_type, 1, 1) AS sim, count(*) AS n_frames, count(*) AS n_places, count(*) AS n_last,
  round(320 * {EV}, 9) AS fparam FROM labels_of GROUP BY ALL"""


def score_job(spark, sf_dir) -> DataFrame:
    """Forces and energies of two folders of array files scored; some values are not finite, some frames on one side only."""
    rows = cut_lineage(at.atoms(spark, sf_dir))
    top = rows.agg(F.max("frame").alias("top"))
    forces = rows.select("frame", "row_idx", F.array("fx", "fy", "fz").alias("ref"), F.array(
        F.when(F.col("row_idx") == 5, F.lit(float("nan"))).otherwise(F.col("fx") * 0.9 + 0.01), F.col("fy") + F.col("row_idx") * 0.001, F.col("fz")).alias("pred"))
    energies = rows.groupBy("frame").agg(F.sum("c_pe").alias("e")).join(F.broadcast(top))  # one row
    energies = energies.select("frame", F.array("e").alias("ref"), F.array(F.col("e") * 1.01).alias("pred"), (F.col("frame") * 4 <= F.col("top") * 3).alias("scored"))
    folder = shared_folder(rows)
    for side in ("pred", "ref"):
        write_npy(forces, folder, "force", F.lit(side), ["frame", "row_idx"], side, ["frame", "row_idx"])
        wanted = energies.where("scored") if side == "pred" else energies
        write_npy(wanted, folder, "energy", F.lit(side), ["frame"], side, ["frame"], True)
    out = score_predictions(spark, f"{folder}/pred", f"{folder}/ref")
    return out.select("quantity", *[round_to(c, 6).alias(c) for c in ("rmse", "mae", "r2")],
                      F.col("n_frames").cast("bigint").alias("n_frames"), F.col("n_unpaired").cast("bigint").alias("n_unpaired"))


SCORE_JOB = f"""WITH {at.ATOMS_SQL},
c AS (SELECT unnest([{{'q': 'force_x', 'r': fx, 'p': CASE WHEN row_idx = 5 THEN NULL ELSE fx * 0.9 + 0.01 END}},
  {{'q': 'force_y', 'r': fy, 'p': fy + row_idx * 0.001}}, {{'q': 'force_z', 'r': fz, 'p': fz}}]) AS u FROM atoms),
e AS (SELECT frame, sum(c_pe) AS r, frame * 4 <= (SELECT max(frame) FROM atoms) * 3 AS scored FROM atoms GROUP BY frame),
v AS (SELECT u.q AS quantity, u.r AS r, u.p AS p FROM c UNION ALL SELECT 'force', u.r, u.p FROM c
  UNION ALL SELECT 'energy', r, r * 1.01 FROM e WHERE scored),
n AS (SELECT 'force' AS kind, (SELECT count(*) FROM atoms) AS n_frames, 0::BIGINT AS n_unpaired
  UNION ALL SELECT 'energy', count(*) FILTER (scored), count(*) FILTER (NOT scored) FROM e)
SELECT quantity, round(sqrt(avg((p - r) * (p - r))), 6) AS rmse, round(avg(abs(p - r)), 6) AS mae,
  round(1 - sum((p - r) * (p - r)) / (count(*) * var_pop(r)), 6) AS r2, any_value(n_frames) AS n_frames, any_value(n_unpaired) AS n_unpaired
FROM v JOIN n ON kind = split_part(quantity, '_', 1) WHERE p IS NOT NULL GROUP BY quantity"""

QUERIES = {
    "npy_round_trip": (npy_round_trip, NPY_ROUND_TRIP),
    "training_files": (training_files, TRAINING_FILES),
    "measured_label_files": (measured_label_files, MEASURED_LABEL_FILES),
    "box_label_files": (box_label_files, BOX_LABEL_FILES),
    "score_job": (score_job, SCORE_JOB),
}
