"""Registered queries: profile, scoring, thermo join, training rows, picks."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import magnitude, round_to
from trajlake.operators import metrics, profile, sampling, thermo, training
from trajlake.plans import bindings as at
from trajlake.session import cut_lineage
from trajlake.sources.thermo import last_per_step


def _rounded(df: DataFrame, names, digits: int = 9) -> DataFrame:
    return df.withColumns({n: round_to(F.col(n), digits) for n in names})


STATS = [f"force_{s}" for s in ("mean", "std", "min", "max")] + [f"pe_{s}" for s in ("mean", "std", "min", "max")]
FORCE = "sqrt(fx*fx + fy*fy + fz*fz)"
PROFILE_SQL = """count(*) AS n_particles, avg(f) AS force_mean, stddev_samp(f) AS force_std, min(f) AS force_min,
  max(f) AS force_max, avg(c_pe) AS pe_mean, stddev_samp(c_pe) AS pe_std, min(c_pe) AS pe_min, max(c_pe) AS pe_max"""


def bead_profile(spark, sf_dir) -> DataFrame:
    """Profile per simulation; the simulation plays the file, the order its step."""
    out = profile.file_profile(at.lines_with_labels(spark, sf_dir), ["sim_type"], "frame")
    return _rounded(out, STATS + [f"force_{q}" for q in profile.QUANTILES])


BEAD_PROFILE = f"""WITH {at.LINES_SQL}, s AS (
  SELECT sim_type, count(DISTINCT frame) AS n_frames, {PROFILE_SQL}, quantile_cont(f, [0.25, 0.5, 0.75, 0.95, 0.99]) AS q
  FROM (SELECT *, {FORCE} AS f FROM lines) GROUP BY sim_type)
SELECT sim_type, n_particles, n_frames, {", ".join(f"round({c}, 9) AS {c}" for c in STATS)},
  {", ".join(f"round(q[{i + 1}], 9) AS force_{n}" for i, n in enumerate(profile.QUANTILES))} FROM s"""


def _files(spark, sf_dir) -> DataFrame:
    """One order as one file, its lines as beads."""
    rows = at.lines_with_labels(spark, sf_dir)
    return profile.file_profile(rows, ["frame", "sim_type", "temp"], "frame", quantiles=False)


FILES_SQL = f"""{at.LINES_SQL}, files AS (
  SELECT frame, sim_type, temp, 1 AS n_frames, {PROFILE_SQL}
  FROM (SELECT *, {FORCE} AS f FROM lines) GROUP BY frame, sim_type, temp)"""


def file_profile(spark, sf_dir) -> DataFrame:
    return _rounded(_files(spark, sf_dir), STATS)


FILE_PROFILE = f"""WITH {FILES_SQL}
SELECT frame, sim_type, temp, n_particles, n_frames::BIGINT AS n_frames, {", ".join(f"round({c}, 9) AS {c}" for c in STATS)} FROM files"""

ROLLUP = ["particles_per_file", "particles_per_frame", "share", "force_std_pooled", *STATS]


def profile_rollup(spark, sf_dir) -> DataFrame:
    return _rounded(profile.profile_rollup(_files(spark, sf_dir)), ROLLUP, 6)


PROFILE_ROLLUP = f"""WITH {FILES_SQL}, g AS (
  SELECT sim_type, temp, CASE grouping(sim_type, temp) WHEN 3 THEN 'all' WHEN 1 THEN 'sim' ELSE 'temp' END AS level,
    count(*) AS n_files, sum(n_particles)::BIGINT AS n_particles, sum(n_frames)::BIGINT AS n_frames, avg(n_particles) AS particles_per_file,
    sum(n_particles) / sum(n_frames) AS particles_per_frame,
    sum(force_mean * n_particles) / sum(n_particles) AS force_mean,
    sum(force_std * n_particles) / sum(n_particles) FILTER (force_std IS NOT NULL) AS force_std,
    min(force_min) AS force_min, max(force_max) AS force_max, sum(pe_mean * n_particles) / sum(n_particles) AS pe_mean,
    sum(pe_std * n_particles) / sum(n_particles) FILTER (pe_std IS NOT NULL) AS pe_std, min(pe_min) AS pe_min, max(pe_max) AS pe_max
  FROM files GROUP BY GROUPING SETS ((), (sim_type), (temp))),
pooled AS (
  SELECT sim_type, temp, CASE grouping(sim_type, temp) WHEN 3 THEN 'all' WHEN 1 THEN 'sim' ELSE 'temp' END AS level,
    stddev_samp({FORCE}) AS force_std_pooled
  FROM lines GROUP BY GROUPING SETS ((), (sim_type), (temp)))
SELECT g.sim_type, g.temp, level, n_files, n_particles, n_frames, {", ".join(f"round({c}, 6) AS {c}" for c in ROLLUP if c != "share")},
  round(n_particles * 100.0::DOUBLE / (SELECT count(*) FROM lines), 6) AS share
FROM g JOIN pooled p USING (level) WHERE g.sim_type IS NOT DISTINCT FROM p.sim_type AND g.temp IS NOT DISTINCT FROM p.temp"""


def force_histogram(spark, sf_dir) -> DataFrame:
    """Weighted 60-bin histogram of the mean force per file."""
    out = profile.histogram(_files(spark, sf_dir), "force_mean", 60, F.col("n_particles"))
    return _rounded(out, ["low", "high", "weight"])


def _histogram_sql(source: str, value: str, weight: str, bins: int, key: str | None = None) -> str:
    part = f"PARTITION BY {key}" if key else ""
    k = f"{key}, " if key else ""
    return f"""r AS (SELECT {k}{value} AS v, {weight}::DOUBLE AS w, min({value}) OVER ({part}) AS lo, max({value}) OVER ({part}) AS hi
    FROM {source}),
b AS (SELECT *, (hi - lo) / {bins} AS width, least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS g FROM r),
c AS (SELECT *, CASE WHEN v < lo + g * width THEN g - 1 WHEN v >= lo + (g + 1) * width AND g < {bins - 1} THEN g + 1
    ELSE g END AS bin FROM b)
SELECT {k}bin::BIGINT AS bin, round(any_value(lo + bin * width), 9) AS low, round(any_value(lo + (bin + 1) * width), 9) AS high,
  count(*) AS n, round(sum(w), 9) AS weight FROM c GROUP BY {k}bin"""


FORCE_HISTOGRAM = f"WITH {FILES_SQL}, {_histogram_sql('files', 'force_mean', 'n_particles', 60)}"


def energy_histogram_by_sim(spark, sf_dir) -> DataFrame:
    out = profile.histogram(_files(spark, sf_dir), "pe_mean", 40, F.col("n_particles"), ["sim_type"])
    return _rounded(out, ["low", "high", "weight"])


ENERGY_HISTOGRAM_BY_SIM = f"WITH {FILES_SQL}, {_histogram_sql('files', 'pe_mean', 'n_particles', 40, 'sim_type')}"


def density_grid(spark, sf_dir) -> DataFrame:
    out = profile.density_grid(_files(spark, sf_dir), "force_mean", "n_particles")
    return _rounded(out.withColumn("grid", F.col("grid").cast("bigint")), ["x", "density"], 6)


DENSITY_GRID = f"""WITH {FILES_SQL}, s AS (
  SELECT min(force_mean) AS lo, max(force_mean) AS hi, sum(n_particles)::DOUBLE AS w,
    sum(n_particles * force_mean) / sum(n_particles) AS m FROM files),
v AS (SELECT sum(n_particles * (force_mean - (SELECT m FROM s)) ** 2) / (sum(n_particles) - 1) AS v FROM files),
p AS (SELECT lo - (hi - lo) * 0.1::DOUBLE AS a, hi + (hi - lo) * 0.1::DOUBLE AS b, w,
    pow(w, -0.2::DOUBLE) * sqrt(v) AS h FROM s, v)
SELECT grid, round(any_value(x), 6) AS x, round(sum(n_particles * exp(-0.5 * pow((x - force_mean) / h, 2))) / any_value(w * h * sqrt(2 * pi())), 6) AS density
FROM (SELECT grid, a + grid * (b - a) / 199 AS x, w, h FROM p, range(200) g(grid)), files GROUP BY grid"""


def temp_boxplot(spark, sf_dir) -> DataFrame:
    out = profile.box_plot(_files(spark, sf_dir), ["sim_type", "temp"], "force_mean")
    return _rounded(out, ["q1", "median", "q3", "mean", "whisker_low", "whisker_high"])


TEMP_BOXPLOT = f"""WITH {FILES_SQL}, q AS (
  SELECT sim_type, temp, quantile_cont(force_mean, 0.25) AS q1, quantile_cont(force_mean, 0.5) AS median,
    quantile_cont(force_mean, 0.75) AS q3 FROM files GROUP BY sim_type, temp)
SELECT sim_type, temp, round(q1, 9) AS q1, round(median, 9) AS median, round(q3, 9) AS q3, count(*) AS n, round(avg(force_mean), 9) AS mean,
  round(min(force_mean) FILTER (force_mean >= q1 - 1.5 * (q3 - q1)), 9) AS whisker_low,
  round(max(force_mean) FILTER (force_mean <= q3 + 1.5 * (q3 - q1)), 9) AS whisker_high,
  count(*) FILTER (force_mean < q1 - 1.5 * (q3 - q1) OR force_mean > q3 + 1.5 * (q3 - q1)) AS n_outside
FROM files JOIN q USING (sim_type, temp) GROUP BY sim_type, temp, q1, median, q3"""


def parity_metrics(spark, sf_dir) -> DataFrame:
    rows = at.predictions(spark, sf_dir)
    each = metrics.parity_metrics(rows, ["component"]).withColumn("component", F.col("component").cast("string"))
    every = metrics.parity_metrics(rows).withColumn("component", F.lit("all"))
    return _rounded(each.unionByName(every), ["rmse", "mae", "r2"], 6)


PARITY_METRICS = f"""WITH {at.PREDICTIONS_SQL}
SELECT coalesce(component::VARCHAR, 'all') AS component, count(*) AS n, round(sqrt(avg((pred - ref) ** 2)), 6) AS rmse,
  round(avg(abs(pred - ref)), 6) AS mae, round(1 - sum((pred - ref) ** 2) / (count(*) * var_pop(ref)), 6) AS r2
FROM predictions GROUP BY GROUPING SETS ((component), ())"""


def error_summary(spark, sf_dir) -> DataFrame:
    return _rounded(metrics.error_summary(at.predictions(spark, sf_dir)), ["mean", "std"], 6)


ERROR_SUMMARY = f"""WITH {at.PREDICTIONS_SQL}
SELECT count(*) AS n, round(avg(pred - ref), 6) AS mean, round(stddev_pop(pred - ref), 6) AS std FROM predictions"""


def error_histogram(spark, sf_dir) -> DataFrame:
    rows = at.predictions(spark, sf_dir).withColumn("error", F.col("pred") - F.col("ref"))
    return _rounded(profile.histogram(rows, "error", 80), ["low", "high", "weight"])


ERROR_HISTOGRAM = f"WITH {at.PREDICTIONS_SQL}, {_histogram_sql('predictions', '(pred - ref)', '1', 80)}"


def _thermo_frames(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = last_per_step(at.thermo(spark, sf_dir), ["sim", "block_id"], ["temp", "press"])
    frames = rows.select("sim", "step").distinct().withColumn(
        "temp_nominal", F.explode(F.array(F.lit(195), F.lit(205), F.lit(260), F.lit(None).cast("int"))))
    return frames, rows


def thermo_join(spark, sf_dir) -> DataFrame:
    frames, rows = _thermo_frames(spark, sf_dir)
    return _rounded(thermo.join_thermo(frames, rows), ["temp_measured", "pressure"])


THERMO_JOIN_SQL = f"""{at.THERMO_SQL}, last AS (
  SELECT sim, block_id, step, arg_max(temp, line_no) AS temp, arg_max(press, line_no) AS press FROM thermo GROUP BY ALL),
means AS (SELECT sim, block_id, avg(temp) AS mean_temp FROM last GROUP BY ALL),
frames AS (SELECT * FROM (SELECT DISTINCT sim, step FROM last), (VALUES (195), (205), (260), (NULL)) v(temp_nominal)),
ranked AS (
  SELECT f.*, l.temp, l.press, coalesce(abs(mean_temp - temp_nominal), 0) AS gap,
    row_number() OVER (PARTITION BY f.sim, f.step, temp_nominal ORDER BY coalesce(abs(mean_temp - temp_nominal), 0), l.block_id) AS k
  FROM frames f JOIN last l USING (sim, step) JOIN means USING (sim, block_id)),
joined AS (
  SELECT sim, step, temp_nominal, CASE WHEN gap <= 50 THEN temp END AS temp_measured, CASE WHEN gap <= 50 THEN press END AS pressure
  FROM ranked WHERE k = 1)"""
THERMO_JOIN = f"""WITH {THERMO_JOIN_SQL}
SELECT sim, step, temp_nominal, round(temp_measured, 9) AS temp_measured, round(pressure, 9) AS pressure FROM joined"""


def thermo_coverage(spark, sf_dir) -> DataFrame:
    frames, rows = _thermo_frames(spark, sf_dir)
    out = thermo.coverage(thermo.join_thermo(frames, rows))
    return _rounded(out, ["matched_pct", "temp_min", "temp_max", "pressure_min", "pressure_max"])


THERMO_COVERAGE = f"""WITH {THERMO_JOIN_SQL}
SELECT count(*) AS n_frames, count(temp_measured) AS n_matched, round(count(temp_measured) * 100::DOUBLE / count(*), 9) AS matched_pct,
  round(min(temp_measured), 9) AS temp_min, round(max(temp_measured), 9) AS temp_max, round(min(pressure), 9) AS pressure_min,
  round(max(pressure), 9) AS pressure_max FROM joined"""


def kelvin_to_ev(spark, sf_dir) -> DataFrame:
    """Temperature labels of all thermo rows, in log order."""
    rows = last_per_step(at.thermo(spark, sf_dir), ["sim", "block_id"], ["temp", "press"])
    return rows.select("sim", "block_id", "first_line", round_to(thermo.in_unit(F.col("temp"), "eV"), 12).alias("fparam"))


KELVIN_TO_EV = f"""WITH {at.THERMO_SQL}
SELECT sim, block_id, min(line_no) AS first_line, round(arg_max(temp, line_no) * 8.617333262e-5::DOUBLE, 12) AS fparam
FROM thermo GROUP BY sim, block_id, step"""


def even_downsample(spark, sf_dir) -> DataFrame:
    """500 events spread evenly over the log."""
    rows = at.thermo(spark, sf_dir).select("line_no", "sim", "step")
    return sampling.even_downsample(rows, 500, [F.col("line_no")])


EVEN_DOWNSAMPLE = f"""WITH {at.THERMO_SQL}, o AS (
  SELECT line_no, sim, step, row_number() OVER (ORDER BY line_no) - 1 AS k, count(*) OVER () AS n FROM thermo)
SELECT line_no, sim, step FROM o WHERE n <= 500 OR k IN (
  SELECT CASE WHEN i = 499 THEN n - 1 ELSE floor(i * ((n - 1) / 499)) END FROM range(500) r(i), (SELECT count(*) AS n FROM thermo))"""


def max_interval_pick(spark, sf_dir) -> DataFrame:
    """At most 20 files per simulation and temperature; one pair has its own limit."""
    files = at.frame_labels(spark, sf_dir).select(
        F.concat(F.lit("run."), F.col("frame"), F.lit(".dump")).alias("file"),
        F.col("sim_type").alias("sim"), F.col("temp").cast("int").alias("temp"))
    limits = spark.createDataFrame([("1-URGENT", 300, 7), ("2-HIGH", None, 11), ("5-LOW", 600, 1)],
                                   "sim string, temp int, max_files int")
    return sampling.pick_files(files, limits, 20)


MAX_INTERVAL_PICK = f"""WITH {at.LABELS_SQL}, o AS (
  SELECT frame, sim_type, temp, row_number() OVER (PARTITION BY sim_type, temp ORDER BY frame) - 1 AS k,
    count(*) OVER (PARTITION BY sim_type, temp) AS n,
    CASE WHEN sim_type = '1-URGENT' AND temp = 300 THEN 7 WHEN sim_type = '2-HIGH' THEN 11
      WHEN sim_type = '5-LOW' AND temp = 600 THEN 1 ELSE 20 END AS m FROM labels_of)
SELECT 'run.' || frame || '.dump' AS file, sim_type AS sim, temp::INTEGER AS temp FROM o
WHERE n <= m OR (m = 1 AND k = n // 2) OR (m > 1 AND list_contains(
  list_transform(range(m), lambda i: round_even(i * ((n - 1) / (m - 1)), 0)::BIGINT), k))"""


def _coded(spark, sf_dir) -> DataFrame:
    return training.type_codes(at.atoms(spark, sf_dir), at.FRAME)


def type_codes(spark, sf_dir) -> DataFrame:
    """Codes from the item quantity, which takes many values per frame."""
    rows = at.atoms(spark, sf_dir).withColumn("kind", F.col("x").cast("bigint"))
    return training.type_codes(rows, at.FRAME, "kind").select(
        "frame", "row_idx", F.col("code").cast("bigint").alias("code"))


TYPE_CODES = f"""WITH {at.ATOMS_SQL}
SELECT frame, row_idx, dense_rank() OVER (PARTITION BY frame ORDER BY x::BIGINT) - 1 AS code FROM atoms"""


def frame_packing(spark, sf_dir) -> DataFrame:
    """Packed frames; the weighted sums change with any change of order."""
    packed = training.pack_frames(_coded(spark, sf_dir), at.FRAME)

    def weighted(name):
        return F.aggregate(F.arrays_zip(F.col(name).alias("v"), F.sequence(F.lit(1), F.size(name)).alias("i")), F.lit(0.0),
                           lambda a, p: a + p["v"] * p["i"])

    return packed.select(
        "frame", "chunk", "n", *[round_to(weighted(c), 6).alias(f"{c}_mark") for c in ("coord", "force", "atom_ener", "codes")],
        round_to("energy", 6).alias("energy"))


FRAME_PACKING = f"""WITH {at.ATOMS_SQL}
SELECT frame, 0 AS chunk, count(*) AS n, round(sum(x * (3 * id - 2) + y * (3 * id - 1) + z * 3 * id), 6) AS coord_mark,
  round(sum(fx * (3 * id - 2) + fy * (3 * id - 1) + fz * 3 * id), 6) AS force_mark, round(sum(c_pe * id), 6) AS atom_ener_mark,
  round(sum((type - 1) * id)::DOUBLE, 6) AS codes_mark, round(sum(c_pe), 6) AS energy FROM atoms GROUP BY frame"""


def set_split(spark, sf_dir) -> DataFrame:
    """Frames of each simulation and temperature in four contiguous sets."""
    return training.split_sets(at.frame_labels(spark, sf_dir), ["sim_type", "temp"], 4, [F.col("frame")])


SET_SPLIT = f"""WITH {at.LABELS_SQL}
SELECT frame, sim_type, temp, row_number() OVER w - 1 AS frame_no, ntile(4) OVER w - 1 AS set_id
FROM labels_of WINDOW w AS (PARTITION BY sim_type, temp ORDER BY frame)"""


def mean_force_by_sim(spark, sf_dir) -> DataFrame:
    """Coarse-grain every frame, then the mean bead force per simulation and temperature."""
    from trajlake.operators import beads as B
    from trajlake.operators.neighbors import with_position
    from trajlake.plans.bead_queries import CUTOFF, PATTERNS
    atoms = cut_lineage(with_position(at.atoms(spark, sf_dir)))
    rules = B.BeadRules(patterns=PATTERNS, r_cutoff=CUTOFF)
    values = B.bead_values(B.distance_members(atoms, at.FRAME, rules), atoms, at.FRAME, rules)
    out = values.join(at.frame_labels(spark, sf_dir), "frame").groupBy("sim_type", "temp").agg(
        F.count(F.lit(1)).alias("n_beads"), F.avg(magnitude(F.col("fx"), F.col("fy"), F.col("fz"))).alias("force_mean"))
    return _rounded(out, ["force_mean"])


QUERIES = {
    "bead_profile": (bead_profile, BEAD_PROFILE),
    "file_profile": (file_profile, FILE_PROFILE),
    "profile_rollup": (profile_rollup, PROFILE_ROLLUP),
    "force_histogram": (force_histogram, FORCE_HISTOGRAM),
    "energy_histogram_by_sim": (energy_histogram_by_sim, ENERGY_HISTOGRAM_BY_SIM),
    "density_grid": (density_grid, DENSITY_GRID),
    "temp_boxplot": (temp_boxplot, TEMP_BOXPLOT),
    "parity_metrics": (parity_metrics, PARITY_METRICS),
    "error_summary": (error_summary, ERROR_SUMMARY),
    "error_histogram": (error_histogram, ERROR_HISTOGRAM),
    "thermo_join": (thermo_join, THERMO_JOIN),
    "thermo_coverage": (thermo_coverage, THERMO_COVERAGE),
    "kelvin_to_ev": (kelvin_to_ev, KELVIN_TO_EV),
    "even_downsample": (even_downsample, EVEN_DOWNSAMPLE),
    "max_interval_pick": (max_interval_pick, MAX_INTERVAL_PICK),
    "type_codes": (type_codes, TYPE_CODES),
    "frame_packing": (frame_packing, FRAME_PACKING),
    "set_split": (set_split, SET_SPLIT),
}
