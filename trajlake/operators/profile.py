"""Bead dataset profile: per-file statistics, roll-ups, histograms, densities, box plots."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import magnitude
from trajlake.operators.joins import join_keys
from trajlake.operators.quantiles import exact_quantiles

# fixed values: reported force quantiles
QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95, "q99": 0.99}


def file_profile(beads: DataFrame, file: Sequence[str], step: str = "timestep",
                 quantiles: bool = True) -> DataFrame:
    """One row per file: counts, force and energy statistics."""
    file = list(file)
    rows = beads.withColumn("_f", magnitude(F.col("fx"), F.col("fy"), F.col("fz")))
    stats = rows.groupBy(*file).agg(
        F.count(F.lit(1)).alias("n_particles"), F.countDistinct(step).alias("n_frames"),
        F.avg("_f").alias("force_mean"), F.stddev_samp("_f").alias("force_std"),
        F.min("_f").alias("force_min"), F.max("_f").alias("force_max"),
        F.avg("c_pe").alias("pe_mean"), F.stddev_samp("c_pe").alias("pe_std"),
        F.min("c_pe").alias("pe_min"), F.max("c_pe").alias("pe_max"))
    if quantiles:
        q = exact_quantiles(rows, file, "_f", list(QUANTILES.values()))
        stats = join_keys(stats, q, file, "left").withColumns(
            {f"force_{name}": F.col("q")[i] for i, name in enumerate(QUANTILES)}).drop("q")
    return stats


def _weighted(value: str) -> Column:
    w = F.col("n_particles")
    return F.sum(F.col(value) * w) / F.sum(F.when(F.col(value).isNotNull(), w))


def profile_rollup(files: DataFrame) -> DataFrame:
    """Totals, per simulation and per temperature in one pass of grouping sets.

    Means and deviations are weighted by beads; ``force_std_pooled`` is the
    deviation of all beads together.
    """
    w = F.col("n_particles")
    second = F.sum((w - 1) * F.col("force_std") * F.col("force_std"))
    between = F.sum(w * F.col("force_mean") * F.col("force_mean")) - F.pow(F.sum(w * F.col("force_mean")), 2) / F.sum(w)
    sets = files.groupingSets([[], ["sim_type"], ["temp"]], "sim_type", "temp").agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("n_files"), F.sum("n_particles").alias("n_particles"),
        F.sum("n_frames").alias("n_frames"), F.avg("n_particles").alias("particles_per_file"),
        (F.sum("n_particles") / F.sum("n_frames")).alias("particles_per_frame"),
        _weighted("force_mean").alias("force_mean"), _weighted("force_std").alias("force_std"),
        F.sqrt((F.coalesce(second, F.lit(0.0)) + between) / F.nullif(F.sum(w) - 1, F.lit(0))).alias("force_std_pooled"),
        F.min("force_min").alias("force_min"), F.max("force_max").alias("force_max"),
        _weighted("pe_mean").alias("pe_mean"), _weighted("pe_std").alias("pe_std"),
        F.min("pe_min").alias("pe_min"), F.max("pe_max").alias("pe_max"))
    level = F.when(F.col("_g") == 3, "all").when(F.col("_g") == 1, "sim").otherwise("temp")
    sets = sets.withColumn("level", level).where((F.col("level") != "temp") | F.col("temp").isNotNull())
    total = files.agg(F.sum("n_particles").alias("n"))
    return sets.withColumn("share", F.col("n_particles") * 100.0 / total.scalar()).drop("_g")


def histogram(df: DataFrame, value: str, bins: int, weight: Column | None = None,
              keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bin, low, high, n, weight) over equal-width bins of [min, max].

    The last bin includes its upper edge; a single value gets a bin range of
    width one around it.  Empty bins are not listed.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"),
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("_w"))
    same = F.min("_v") == F.max("_v")
    low = F.when(same, F.min("_v") - 0.5).otherwise(F.min("_v"))
    high = F.when(same, F.max("_v") + 0.5).otherwise(F.max("_v"))
    if keys:
        rows = join_keys(rows, rows.groupBy(*keys).agg(low.alias("_lo"), high.alias("_hi")), keys)
    else:
        ends = rows.agg(F.struct(low.alias("lo"), high.alias("hi")).alias("e")).scalar()
        rows = rows.withColumns({"_lo": ends["lo"], "_hi": ends["hi"]})
    width = (F.col("_hi") - F.col("_lo")) / bins
    guess = F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))
    rows = rows.withColumn("_g", guess)
    # settle values that rounding put on the wrong side of an edge
    fixed = (F.when(F.col("_v") < F.col("_lo") + F.col("_g") * width, F.col("_g") - 1)
             .when((F.col("_v") >= F.col("_lo") + (F.col("_g") + 1) * width) & (F.col("_g") < bins - 1), F.col("_g") + 1)
             .otherwise(F.col("_g")))
    out = rows.withColumn("bin", fixed.cast("bigint")).groupBy(*keys, "bin").agg(
        F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
        F.count(F.lit(1)).alias("n"), F.sum("_w").alias("weight"))
    return out.select(*keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("low"),
                      (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"), "n", "weight")


def density_grid(df: DataFrame, value: str, weight: str, points: int = 200, margin: float = 0.1,
                 sample_cap: int | None = None) -> DataFrame:
    """(grid, x, density): weighted Gaussian density estimate on an even grid.

    Scott's bandwidth of the whole weight; ``sample_cap`` limits the sample
    size the bandwidth assumes.  All values enter with their weights.
    """
    rows = df.where(F.col(value).isNotNull()).select(
        F.col(value).cast("double").alias("_v"), F.col(weight).cast("double").alias("_w"))
    w, v = F.sum("_w"), F.sum(F.col("_w") * F.col("_v"))
    facts = rows.agg(F.struct(
        F.min("_v").alias("lo"), F.max("_v").alias("hi"), w.alias("w"), (v / w).alias("mean")).alias("s")).scalar()
    spread = rows.withColumn("_m", facts["mean"]).agg(
        (F.sum(F.col("_w") * (F.col("_v") - F.col("_m")) * (F.col("_v") - F.col("_m"))) / F.nullif(F.sum("_w") - 1, F.lit(0.0))).alias("v")).scalar()
    n = facts["w"] if sample_cap is None else F.least(facts["w"], F.lit(float(sample_cap)))
    rows = rows.withColumns({
        "_lo": facts["lo"], "_hi": facts["hi"], "_tot": facts["w"],
        "_h": F.nullif(F.pow(n, F.lit(-0.2)) * F.sqrt(spread), F.lit(0.0))})
    pad = (F.col("_hi") - F.col("_lo")) * margin
    start, stop = F.col("_lo") - pad, F.col("_hi") + pad
    rows = rows.select("*", start.alias("_a"), stop.alias("_b"),
                       F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("grid"))
    x = F.col("_a") + F.col("grid") * (F.col("_b") - F.col("_a")) / (points - 1)
    u = (x - F.col("_v")) / F.col("_h")
    norm = F.col("_tot") * F.col("_h") * F.sqrt(F.lit(2.0) * F.pi())
    return rows.groupBy("grid").agg(
        F.first(x).alias("x"), F.sum(F.col("_w") * F.exp(-u * u / 2) / norm).alias("density"))


def box_plot(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, mean, q1, median, q3, whisker_low, whisker_high, n_outside)."""
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    q = exact_quantiles(rows, keys, "_v", (0.25, 0.5, 0.75)).select(
        *keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col("_v").between(low, high)
    return join_keys(rows, q, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"),
        F.least(F.coalesce(F.min(F.when(inside, F.col("_v"))), F.col("q1")), F.col("q1")).alias("whisker_low"),
        F.greatest(F.coalesce(F.max(F.when(inside, F.col("_v"))), F.col("q3")), F.col("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("n_outside"))


def controlled_temperature_only(df: DataFrame) -> DataFrame:
    """Rows of simulations named npt or nvt with a known temperature."""
    return df.where(F.col("temp").isNotNull() & F.col("sim_type").rlike("npt|nvt"))
