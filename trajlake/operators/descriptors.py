"""Structure descriptors of frames, scaling, principal components."""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import min_image, squared_distance
from trajlake.operators.neighbors import LENGTHS, POSITION, cell_pairs, largest_frame

PAIR_WINDOW = 99
PAIR_VALUES = 500  # of the explicit prefix form
HISTOGRAM_BINS = 16
HISTOGRAM_REACH = 16.0
DENSITY_BINS = 8
DENSITY_SLOTS = 4 * DENSITY_BINS  # type pairs of two types
SPECTRUM_RADIAL, SPECTRUM_DEGREE = 3, 3


def pair_descriptor(atoms: DataFrame, frame: Sequence[str], values: int = PAIR_VALUES) -> DataFrame:
    """(frame, features): [distance, type i, type j] of the pairs i < j < i+100 in
    (i, j) order, cut to ``values`` numbers.

    The first ceil(values / 3) pairs come from a bounded number of leading
    rows, so the rest of the frame is filtered out before the shuffle.
    Distances do not change under centering.  Small frames give shorter arrays.
    """
    frame = list(frame)
    pairs = -(-values // 3)
    rows_needed = PAIR_WINDOW + 1 + -(-pairs // PAIR_WINDOW)
    few = (atoms.where(F.col("row_idx") < rows_needed).groupBy(*frame).agg(
        F.array_sort(F.collect_list(F.struct("row_idx", "type", *POSITION))).alias("_a"),
        *[F.first(l).alias(l) for l in LENGTHS]))

    def with_later(a: Column) -> Column:
        later = F.filter("_a", lambda b: (b["row_idx"] > a["row_idx"]) & (b["row_idx"] <= a["row_idx"] + PAIR_WINDOW))
        return F.transform(later, lambda b: F.array(
            F.sqrt(squared_distance([a[p] for p in POSITION], [b[p] for p in POSITION], [F.col(l) for l in LENGTHS])),
            a["type"].cast("double"), b["type"].cast("double")))

    # rows before which fewer than the wanted pairs have been listed
    n = F.least(F.size("_a"), F.lit(PAIR_WINDOW + 1))
    leading = F.filter("_a", lambda a, i: i * (2 * n - 1 - i) / 2 < pairs)
    nested = F.transform(leading, with_later)
    return few.select(*frame, F.slice(F.flatten(F.flatten(nested)), 1, values).alias("features"))


def pair_histogram(atoms: DataFrame, frame: Sequence[str], bins: int = HISTOGRAM_BINS,
                   reach: float = HISTOGRAM_REACH) -> DataFrame:
    """(frame, type_i, type_j, bin, n): all pairs i < j < i+100 by type pair and distance.

    The last bin also holds all larger distances.  A block of rows meets its own
    and the next block, so each row is paired with at most two blocks and no
    frame is collected.
    """
    frame = list(frame)
    width = PAIR_WINDOW + 1
    block = F.floor(F.col("row_idx") / width)
    left = atoms.select(*frame, *LENGTHS, block.alias("_b"), F.col("row_idx").alias("_i"), F.col("type").alias("type_i"),
                        *[F.col(p).alias(f"_{p}") for p in POSITION])
    right = atoms.select(*frame, F.explode(F.array(block, block - 1)).alias("_b"), F.col("row_idx").alias("_j"),
                         F.col("type").alias("type_j"), *POSITION)
    pairs = left.join(right, [*frame, "_b"]).where((F.col("_j") > F.col("_i")) & (F.col("_j") - F.col("_i") <= PAIR_WINDOW))
    d = F.sqrt(squared_distance([F.col(f"_{p}") for p in POSITION], [F.col(p) for p in POSITION], [F.col(l) for l in LENGTHS]))
    place = F.least(F.floor(d * (bins / reach)), F.lit(bins - 1)).cast("int")
    return pairs.groupBy(*frame, "type_i", "type_j", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_vectors(frames: DataFrame, histogram: DataFrame, frame: Sequence[str], bins: int = HISTOGRAM_BINS,
                      types: Sequence[int] = (1, 2)) -> DataFrame:
    """(frame, features): shares of a frame's pairs, one slot per type pair and bin; zeros without pairs."""
    total = F.nullif(F.sum("n"), F.lit(0))
    slots = [F.coalesce(F.sum(F.when((F.col("type_i") == a) & (F.col("type_j") == b) & (F.col("bin") == k), F.col("n"))) / total, F.lit(0.0))
             for a in types for b in types for k in range(bins)]
    found = histogram.groupBy(*frame).agg(F.array(*slots).alias("features"))
    empty = F.array_repeat(F.lit(0.0), bins * len(types) ** 2)
    return frames.join(found, list(frame), "left").withColumn("features", F.coalesce("features", empty))


def density_descriptor(atoms: DataFrame, frame: Sequence[str], rcut: float = 5.0, n_max: int = DENSITY_BINS,
                       sigma: float = 0.5) -> DataFrame:
    """(frame, type_i, type_j, bin, density): Gaussian-smeared neighbour density
    per type pair and radial bin, averaged over the atoms of the frame.

    Atoms at the same place are merged with a weight before the pair join.
    """
    frame = list(frame)
    spots = atoms.groupBy(*frame, "type", *POSITION).agg(
        F.count(F.lit(1)).alias("w"), F.min("row_idx").alias("spot"), *[F.first(l).alias(l) for l in LENGTHS])
    sizes = atoms.groupBy(*frame).agg(F.count(F.lit(1)).alias("_n"))
    left = spots.select(*frame, *POSITION, *LENGTHS, F.col("type").alias("type_i"), F.col("w").alias("wi"), F.col("spot").alias("si"))
    right = spots.select(*frame, *POSITION, *LENGTHS, F.col("type").alias("type_j"), F.col("w").alias("wj"), F.col("spot").alias("sj"))
    pairs = cell_pairs(left, right, frame, rcut, crowd=largest_frame(atoms, frame))
    same = (F.col("si") == F.col("sj")) & (F.col("type_i") == F.col("type_j"))
    pairs = pairs.withColumn("_w", F.when(same, F.col("wi") * (F.col("wj") - 1)).otherwise(F.col("wi") * F.col("wj")))
    centers = [(k + 0.5) * rcut / n_max for k in range(n_max)]
    r = F.sqrt("d2")
    smeared = F.array(*[F.col("_w") * F.exp(-F.pow(r - c, 2) / (2 * sigma * sigma)) for c in centers])
    sums = (pairs.where(F.col("_w") > 0).select(*frame, "type_i", "type_j", F.posexplode(smeared).alias("bin", "_g"))
            .groupBy(*frame, "type_i", "type_j", "bin").agg(F.sum("_g").alias("_s")))
    return sums.join(sizes, frame).select(*frame, "type_i", "type_j", "bin", (F.col("_s") / F.col("_n")).alias("density"))


def density_vectors(density: DataFrame, frame: Sequence[str], n_max: int = DENSITY_BINS,
                    types: Sequence[int] = (1, 2)) -> DataFrame:
    """(frame, features): one slot per type pair and bin, zero where nothing is near."""
    slots = [F.coalesce(F.max(F.when((F.col("type_i") == a) & (F.col("type_j") == b) & (F.col("bin") == k), F.col("density"))), F.lit(0.0))
             for a in types for b in types for k in range(n_max)]
    return density.groupBy(*frame).agg(F.array(*slots).alias("features"))


def radial_basis(n_max: int, rcut: float) -> list[list[float]]:
    """Factors of (rcut - r)^3, (rcut - r)^4, ... in ``n_max`` functions that are orthonormal over 0..rcut."""
    a = np.arange(1, n_max + 1)
    overlap = np.sqrt(np.outer(2 * a + 5, 2 * a + 5)) / (5 + a[:, None] + a)
    values, vectors = np.linalg.eigh(overlap)
    return (vectors / np.sqrt(values) @ vectors.T * np.sqrt((2 * a + 5) / rcut ** (2.0 * a + 5))).tolist()


def real_harmonics(x, y, z, l_max: int) -> list[list]:
    """Real spherical harmonics of a unit direction, a list of 2l + 1 for each l, as polynomials of columns or numbers.

    A zero vector has no direction: all but l = 0 vanish.
    """
    square = x * x + y * y + z * z
    cos, sin = [1.0], [0.0]  # of m times the azimuth, times the distance from the axis to the m
    for _ in range(l_max):
        cos, sin = [*cos, x * cos[-1] - y * sin[-1]], [*sin, x * sin[-1] + y * cos[-1]]
    polar: dict[tuple[int, int], object] = {}
    for m in range(l_max + 1):
        polar[m, m] = float(math.prod(range(1, 2 * m, 2)))
        for l in range(m + 1, l_max + 1):
            before = (l + m - 1) * square * polar[l - 2, m] if l > m + 1 else 0.0
            polar[l, m] = ((2 * l - 1) * z * polar[l - 1, m] - before) * (1 / (l - m))
    out = []
    for l in range(l_max + 1):
        own = [math.sqrt((2 * l + 1) / (4 * math.pi)) * polar[l, 0]]
        for m in range(1, l + 1):
            scale = math.sqrt((2 * l + 1) / (2 * math.pi) * math.factorial(l - m) / math.factorial(l + m))
            own += [scale * polar[l, m] * cos[m], scale * polar[l, m] * sin[m]]
        out.append(own)
    return out


def spectrum_slots(n_max: int = SPECTRUM_RADIAL, l_max: int = SPECTRUM_DEGREE, types: Sequence[int] = (1, 2)) -> list[tuple[int, int, int, int, int]]:
    """(type 1, n 1, type 2, n 2, l) of each place of an angular spectrum."""
    channels = [(t, n) for t in types for n in range(n_max)]
    return [(*a, *b, l) for i, a in enumerate(channels) for b in channels[i:] for l in range(l_max + 1)]


def angular_spectrum(atoms: DataFrame, frame: Sequence[str], rcut: float = 5.0, n_max: int = SPECTRUM_RADIAL,
                     l_max: int = SPECTRUM_DEGREE, types: Sequence[int] = (1, 2)) -> DataFrame:
    """(frame, type_i, features): how the surroundings of the atoms of a type look, whichever way they are turned.

    The neighbours of an atom, by type, are expanded in radial functions times
    spherical harmonics; products of two expansions summed over m do not change
    when the frame is rotated, moved or its atoms are relabelled.  They are
    summed over the atoms and divided by the number of atoms of the frame;
    places as in ``spectrum_slots``.  Neighbours at the same place count for
    l = 0 only.  Types without any neighbour in reach have no row, other types than
    ``types`` are no neighbours.

    One aggregate by atom, one by frame, both combined before the shuffle; a
    pair stays one row.  Atoms at the same place are merged with a weight first.
    """
    frame = list(frame)
    spots = atoms.groupBy(*frame, "type", *POSITION).agg(
        F.count(F.lit(1)).alias("w"), F.min("row_idx").alias("spot"), *[F.first(l).alias(l) for l in LENGTHS])
    sizes = atoms.groupBy(*frame).agg(F.count(F.lit(1)).alias("_n"))
    left = spots.select(*frame, *POSITION, *LENGTHS, F.col("type").alias("type_i"), F.col("w").alias("wi"), F.col("spot").alias("si"))
    right = (spots.where(F.col("type").isin(*types))
             .select(*frame, *POSITION, *LENGTHS, F.col("type").alias("type_j"), F.col("w").alias("wj"), F.col("spot").alias("sj"),
                     *[F.col(p).alias(f"_to{p}") for p in POSITION]))
    pairs = cell_pairs(left, right, frame, rcut, crowd=largest_frame(atoms, frame))
    same = (F.col("si") == F.col("sj")) & (F.col("type_i") == F.col("type_j"))
    inverse = F.when(F.col("d2") > 0, 1 / F.sqrt("d2")).otherwise(0.0)
    rest = F.lit(rcut) - F.sqrt("d2")
    pairs = pairs.select(*frame, "type_i", "si", "wi", "type_j", F.when(same, F.col("wj") - 1).otherwise(F.col("wj")).alias("_w"), rest.alias("_rest"),
                         *[(min_image(F.col(f"_to{p}") - F.col(p), F.col(l)) * inverse).alias(f"_u{i}") for i, (p, l) in enumerate(zip(POSITION, LENGTHS))])
    cubed = F.col("_rest") * F.col("_rest") * F.col("_rest")
    powers = [cubed]
    for _ in range(n_max - 1):
        powers.append(powers[-1] * F.col("_rest"))
    radial = [sum(f * p for f, p in zip(row, powers)) for row in radial_basis(n_max, rcut)]
    harmonics = [y for own in real_harmonics(*[F.col(f"_u{i}") for i in range(3)], l_max) for y in own]
    pairs = pairs.where(F.col("_w") > 0).select(
        *frame, "type_i", "si", "wi", "type_j", *[(F.col("_w") * g).alias(f"_g{n}") for n, g in enumerate(radial)],
        *[(y if isinstance(y, Column) else F.lit(y)).alias(f"_y{k}") for k, y in enumerate(harmonics)])
    atoms_of_spot = pairs.groupBy(*frame, "type_i", "si").agg(F.first("wi").alias("wi"), *[
        F.sum(F.when(F.col("type_j") == t, F.col(f"_g{n}") * F.col(f"_y{k}")).otherwise(0.0)).alias(f"_c{t}_{n}_{k}")
        for t in types for n in range(n_max) for k in range(len(harmonics))])
    power = [F.sum(F.col("wi") * sum(F.col(f"_c{t}_{n}_{k}") * F.col(f"_c{u}_{o}_{k}") for k in range(l * l, (l + 1) * (l + 1))))
             for t, n, u, o, l in spectrum_slots(n_max, l_max, types)]
    sums = atoms_of_spot.groupBy(*frame, "type_i").agg(F.array(*power).alias("_s"))
    return sums.join(sizes, frame).select(*frame, "type_i", F.transform("_s", lambda s: s / F.col("_n")).alias("features"))


def spectrum_vectors(frames: DataFrame, spectrum: DataFrame, frame: Sequence[str], n_max: int = SPECTRUM_RADIAL,
                     l_max: int = SPECTRUM_DEGREE, types: Sequence[int] = (1, 2)) -> DataFrame:
    """(frame, features): the spectra of all types one after the other; zeros for types and frames without neighbours."""
    empty = F.array_repeat(F.lit(0.0), len(spectrum_slots(n_max, l_max, types)))
    parts = [F.coalesce(F.first(F.when(F.col("type_i") == t, F.col("features")), ignorenulls=True), empty) for t in types]
    found = spectrum.groupBy(*frame).agg(F.concat(*parts).alias("features"))
    nothing = F.concat(*[empty] * len(types))
    return frames.join(found, list(frame), "left").withColumn("features", F.coalesce("features", nothing))


def equal_length(vectors: DataFrame, features: str = "features") -> DataFrame:
    """Pad shorter vectors with zeros to the longest; ``padded`` counts the added slots."""
    longest = vectors.agg(F.max(F.size(features)).alias("n")).scalar()
    missing = longest - F.size(features)
    return vectors.withColumn("padded", missing).withColumn(
        features, F.concat(F.col(features), F.array_repeat(F.lit(0.0), F.col("padded"))))


def standardize(vectors: DataFrame, features: str = "features") -> DataFrame:
    """Columns to mean 0 and population deviation 1; constant columns to 0.

    Mean and variance of all dimensions come from one mergeable aggregate; the
    single row it gives has the width of one vector.
    """
    v = array_to_vector(features)
    stats = vectors.select(Summarizer.metrics("mean", "variance", "count").summary(v).alias("s")).select(
        F.struct(vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"),
                 F.col("s.count").alias("n")).alias("s")).scalar()
    rows = vectors.withColumn("_s", stats)
    population = (F.col("_s.n") - 1) / F.col("_s.n")
    scaled = F.zip_with(F.arrays_zip(F.col(features).alias("x"), F.col("_s.mean").alias("m")), "_s.var",
                        lambda p, var: F.when(var > 0, (p["x"] - p["m"]) / F.sqrt(var * population)).otherwise(F.lit(0.0)))
    return rows.withColumn(features, scaled).drop("_s")


def principal_components(vectors: DataFrame, k: int = 10, features: str = "features"):
    """(scores, ratios): PC1..PCk of centered vectors and the explained shares.

    ``k`` is limited by the vector width and the number of rows.  The sign of a
    component makes its largest loading positive.  The model is as wide as one
    vector, whatever the number of rows.
    """
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(features)).alias("d")).first()
    k = max(1, min(k, facts["d"], facts["n"]))
    rows = vectors.withColumn("_v", array_to_vector(features))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(rows)
    loads = model.pc.toArray()
    signs = [1.0 if loads[abs(loads[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]
    # scores of centered data, whether or not the input was centered
    center = (rows.select(Summarizer.mean(F.col("_v")).alias("m")).first()["m"].toArray() @ loads).tolist()
    scores = model.transform(rows).withColumn("_a", vector_to_array("_p"))
    scores = scores.select(*[c for c in vectors.columns if c != features],
                           *[((F.col("_a")[i] - center[i]) * signs[i]).alias(f"PC{i + 1}") for i in range(k)])
    return scores, [float(x) for x in model.explainedVariance]
