"""Registered queries: graphs, descriptors, projection, clustering, selection."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.geometry import round_to
from trajlake.operators import clustering as C
from trajlake.operators import descriptors as D
from trajlake.operators import graphs as G
from trajlake.operators import pairwise as P
from trajlake.operators import selection as S
from trajlake.operators.neighbors import with_position
from trajlake.plans import bindings as at

EPS = 0.2
MIN_SAMPLES = 5


def _atoms(spark, sf_dir) -> DataFrame:
    return with_position(at.atoms(spark, sf_dir))


def _vectors(spark, sf_dir, dims: int) -> DataFrame:
    cols = [f"f{i + 1}" for i in range(dims)]
    return C.as_vectors(at.descriptors(spark, sf_dir, dims), cols, ("id", "label"))


def window_edges(spark, sf_dir) -> DataFrame:
    return G.window_edges(_atoms(spark, sf_dir), at.FRAME)


WINDOW_EDGES = f"""WITH {at.ATOMS_SQL}
SELECT a.frame, a.row_idx AS src, b.row_idx AS dst FROM atoms a JOIN atoms b ON a.frame = b.frame
WHERE a.row_idx <> b.row_idx AND abs(a.row_idx - b.row_idx) < 20"""

DIST2_SQL = """pow((b.x-a.x) - round_even((b.x-a.x)/a.lx,0)*a.lx, 2) + pow((b.y-a.y) - round_even((b.y-a.y)/a.ly,0)*a.ly, 2)
      + pow((b.z-a.z) - round_even((b.z-a.z)/a.lz,0)*a.lz, 2)"""


def contact_edges(spark, sf_dir) -> DataFrame:
    out = G.contact_edges(_atoms(spark, sf_dir), at.FRAME)
    return out.withColumn("d2", round_to("d2", 9))


CONTACT_SQL = f"""SELECT a.frame, a.row_idx AS src, b.row_idx AS dst, {DIST2_SQL} AS d2
  FROM atoms a JOIN atoms b ON a.frame = b.frame AND a.row_idx < b.row_idx"""
CONTACT_EDGES = f"""WITH {at.ATOMS_SQL}
SELECT frame, src, dst, round(d2, 9) AS d2 FROM ({CONTACT_SQL}) WHERE d2 < (10 * 0.3::DOUBLE) * (10 * 0.3::DOUBLE)"""


def graph_stats(spark, sf_dir) -> DataFrame:
    out = G.graph_statistics(_atoms(spark, sf_dir), at.FRAME)
    return out.withColumns({c: round_to(F.col(c), 9) for c in ("avg_degree", "avg_clustering")})


GRAPH_STATS = f"""WITH {at.ATOMS_SQL}, e AS (
  SELECT * FROM ({CONTACT_SQL}) WHERE d2 < (10 * 0.3::DOUBLE) * (10 * 0.3::DOUBLE) AND dst - src < 20),
b AS (SELECT frame, src AS n, dst AS m FROM e UNION ALL SELECT frame, dst, src FROM e),
k AS (SELECT frame, n, count(*) AS k FROM b GROUP BY frame, n),
t AS (SELECT p.frame, p.n, count(*) AS t FROM b p JOIN b q ON p.frame = q.frame AND p.n = q.n AND p.m < q.m
  JOIN e ON e.frame = p.frame AND e.src = p.m AND e.dst = q.m GROUP BY p.frame, p.n)
SELECT a.frame, count(*) AS nodes, (sum(coalesce(k, 0)) / 2)::BIGINT AS edges, round(avg(coalesce(k, 0)), 9) AS avg_degree,
  round(avg(CASE WHEN k >= 2 THEN 2 * coalesce(t, 0) / (k * (k - 1)) ELSE 0 END), 9) AS avg_clustering
FROM atoms a LEFT JOIN k ON k.frame = a.frame AND k.n = a.row_idx LEFT JOIN t ON t.frame = a.frame AND t.n = a.row_idx GROUP BY a.frame"""


def node_features(spark, sf_dir) -> DataFrame:
    out = G.feature_profile(G.node_features(_atoms(spark, sf_dir)))
    return out.withColumns({c: round_to(F.col(c), 9) for c in ("mean_type1", "mean_type2", "variance")})


FEATURES_SQL = """feats AS (SELECT type, [CASE type WHEN 1 THEN 1 ELSE 0 END, CASE type WHEN 2 THEN 1 ELSE 0 END, sin(x), cos(x), 0,
    sin(y), cos(y), 0, sin(z), cos(z), 0, 0, 0, 0, 0, 0]::DOUBLE[] AS f FROM atoms)"""
NODE_FEATURES = f"""WITH {at.ATOMS_SQL}, {FEATURES_SQL}, u AS (SELECT type, unnest(f) AS v, generate_subscripts(f, 1) - 1 AS feature FROM feats)
SELECT feature, round(avg(v) FILTER (type = 1), 9) AS mean_type1, round(avg(v) FILTER (type = 2), 9) AS mean_type2,
  round(var_pop(v), 9) AS variance FROM u GROUP BY feature"""


def feature_correlation(spark, sf_dir) -> DataFrame:
    out = G.feature_correlation(G.node_features(_atoms(spark, sf_dir)))
    return out.withColumn("corr", round_to("corr", 9))


FEATURE_CORRELATION = f"""WITH {at.ATOMS_SQL}, {FEATURES_SQL}
SELECT a, b, CASE WHEN var_pop(f[a + 1]) > 0 AND var_pop(f[b + 1]) > 0 THEN round(corr(f[a + 1], f[b + 1]), 9) END AS corr
FROM feats, range(16) p(a), range(16) q(b) WHERE a < b GROUP BY a, b"""


def _mark(name: str):
    """Order-sensitive sum of an array."""
    return F.aggregate(F.arrays_zip(F.col(name).alias("v"), F.sequence(F.lit(1), F.size(name)).alias("i")), F.lit(0.0),
                       lambda a, p: a + p["v"] * p["i"])


def pair_histogram(spark, sf_dir) -> DataFrame:
    out = D.pair_histogram(_atoms(spark, sf_dir), at.FRAME)
    return out.select("frame", *[F.col(c).cast("bigint").alias(c) for c in ("type_i", "type_j", "bin")], "n")


_PAIRS_IN_WINDOW = f"""p AS (
  SELECT a.frame, sqrt({DIST2_SQL}) AS d, a.type AS ti, b.type AS tj,
    row_number() OVER (PARTITION BY a.frame ORDER BY a.row_idx, b.row_idx) - 1 AS k
  FROM atoms a JOIN atoms b ON a.frame = b.frame AND b.row_idx > a.row_idx AND b.row_idx <= a.row_idx + 99)"""
PAIR_HISTOGRAM = f"""WITH {at.ATOMS_SQL}, {_PAIRS_IN_WINDOW}
SELECT frame, ti::BIGINT AS type_i, tj::BIGINT AS type_j, least(floor(d), 15)::BIGINT AS bin, count(*) AS n FROM p GROUP BY ALL"""


def pair_descriptor(spark, sf_dir) -> DataFrame:
    """The explicit prefix form: its length is the feature."""
    out = D.pair_descriptor(_atoms(spark, sf_dir), at.FRAME)
    out = out.where(F.size("features") > 0)
    return out.select("frame", F.size("features").cast("bigint").alias("n"), round_to(_mark("features"), 6).alias("mark"))


PAIR_DESCRIPTOR = f"""WITH {at.ATOMS_SQL}, {_PAIRS_IN_WINDOW}
SELECT frame, least(count(*) * 3, 500) AS n, round(sum(d * (3 * k + 1) + CASE WHEN k < 166 THEN ti * (3 * k + 2) + tj * (3 * k + 3)
  WHEN k = 166 THEN ti * (3 * k + 2) ELSE 0 END), 6) AS mark FROM p WHERE k < 167 GROUP BY frame"""


def density_descriptor(spark, sf_dir) -> DataFrame:
    out = D.density_descriptor(_atoms(spark, sf_dir), at.FRAME)
    return out.select("frame", *[F.col(c).cast("bigint").alias(c) for c in ("type_i", "type_j", "bin")],
                      round_to("density", 9).alias("density"))


DENSITY_DESCRIPTOR = f"""WITH {at.ATOMS_SQL}, p AS (
  SELECT a.frame, a.type AS ti, b.type AS tj, {DIST2_SQL} AS d2 FROM atoms a JOIN atoms b ON a.frame = b.frame AND a.row_idx <> b.row_idx),
n AS (SELECT frame, count(*) AS n FROM atoms GROUP BY frame)
SELECT frame, ti::BIGINT AS type_i, tj::BIGINT AS type_j, bin, round(sum(exp(-0.5 * pow((sqrt(d2) - (bin + 0.5::DOUBLE) * 5 / 8) / 0.5::DOUBLE, 2)))
  / any_value(n), 9) AS density FROM p JOIN n USING (frame), range(8) b(bin) WHERE d2 <= 25 GROUP BY frame, ti, tj, bin"""


def angular_spectrum(spark, sf_dir) -> DataFrame:
    """Rotation-invariant products up to l = 2 of the surroundings of each frame's atoms."""
    out = D.angular_spectrum(_atoms(spark, sf_dir), at.FRAME, n_max=2, l_max=2)
    slots = F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in zip(("type_1", "n_1", "type_2", "n_2", "l"), s)])
                      for s in D.spectrum_slots(2, 2)])
    rows = out.withColumn("slots", slots).select("frame", F.col("type_i").cast("bigint").alias("type_i"),
                                                 F.inline(F.arrays_zip("slots", "features")))
    return rows.select("frame", "type_i", "slots.*", round_to("features", 6).alias("power")).where("power <> 0")


# radial functions by the closed inverse root of a 2 x 2 matrix, harmonics as they stand in textbooks
ANGULAR_SPECTRUM = f"""WITH {at.ATOMS_SQL}, p AS (
  SELECT a.frame, a.row_idx AS i, a.type AS ti, b.type AS tj, {DIST2_SQL} AS d2,
    (b.x-a.x) - round_even((b.x-a.x)/a.lx,0)*a.lx AS dx, (b.y-a.y) - round_even((b.y-a.y)/a.ly,0)*a.ly AS dy,
    (b.z-a.z) - round_even((b.z-a.z)/a.lz,0)*a.lz AS dz
  FROM atoms a JOIN atoms b ON a.frame = b.frame AND a.row_idx <> b.row_idx),
s AS (SELECT sqrt(63::DOUBLE) / 8 AS s),
w AS (SELECT (1 / sqrt(1 + s) + 1 / sqrt(1 - s)) / 2 AS same, (1 / sqrt(1 + s) - 1 / sqrt(1 - s)) / 2 AS cross_ FROM s),
f AS (SELECT frame, i, ti, tj, CASE WHEN d2 > 0 THEN dx / sqrt(d2) ELSE 0 END AS x, CASE WHEN d2 > 0 THEN dy / sqrt(d2) ELSE 0 END AS y,
    CASE WHEN d2 > 0 THEN dz / sqrt(d2) ELSE 0 END AS z, CASE WHEN d2 > 0 THEN 1 ELSE 0 END AS has,
    pow(5 - sqrt(d2), 3) / sqrt(pow(5::DOUBLE, 7) / 7) AS f1, pow(5 - sqrt(d2), 4) / sqrt(pow(5::DOUBLE, 9) / 9) AS f2 FROM p WHERE d2 <= 25),
e AS (SELECT frame, i, ti, tj, unnest([0, 1]) AS n, unnest([same * f1 + cross_ * f2, cross_ * f1 + same * f2]) AS g,
    [0.5 / sqrt(pi()), sqrt(0.75 / pi()) * z, sqrt(0.75 / pi()) * x, sqrt(0.75 / pi()) * y, sqrt(5 / pi()) / 4 * (3 * z * z - has),
     sqrt(15 / pi()) / 2 * x * z, sqrt(15 / pi()) / 2 * y * z, sqrt(15 / pi()) / 4 * (x * x - y * y), sqrt(15 / pi()) / 2 * x * y] AS h FROM f, w),
k AS (SELECT frame, i, ti, tj, n, g, unnest(h) AS h, generate_subscripts(h, 1) - 1 AS k FROM e),
c AS (SELECT frame, i, ti, tj, n, k, CASE WHEN k = 0 THEN 0 WHEN k < 4 THEN 1 ELSE 2 END AS l, sum(g * h) AS c FROM k GROUP BY ALL),
q AS (SELECT u.frame, u.ti, u.tj AS t1, u.n AS n1, v.tj AS t2, v.n AS n2, u.l, sum(u.c * v.c) AS s
  FROM c u JOIN c v ON u.frame = v.frame AND u.i = v.i AND u.k = v.k AND (u.tj < v.tj OR u.tj = v.tj AND u.n <= v.n) GROUP BY ALL),
m AS (SELECT frame, count(*) AS m FROM atoms GROUP BY frame)
SELECT * FROM (SELECT frame, ti::BIGINT AS type_i, t1::BIGINT AS type_1, n1::BIGINT AS n_1, t2::BIGINT AS type_2, n2::BIGINT AS n_2, l::BIGINT AS l,
  round(s / m, 6) AS power FROM q JOIN m USING (frame)) WHERE power <> 0"""


def standardize(spark, sf_dir) -> DataFrame:
    out = D.standardize(at.descriptors(spark, sf_dir))
    return out.select("id", F.posexplode("features").alias("dim", "value")).select(
        "id", F.col("dim").cast("bigint").alias("dim"), round_to("value", 6).alias("value"))


STANDARDIZE = """WITH u AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT id, dim, round((v - avg(v) OVER w) / stddev_pop(v) OVER w, 6) AS value FROM u WINDOW w AS (PARTITION BY dim)"""


def pca_scores(spark, sf_dir) -> DataFrame:
    """Ten components of the standardised descriptors."""
    scores, _ = D.principal_components(D.standardize(at.descriptors(spark, sf_dir)), 10)
    return scores


def pca_variance(spark, sf_dir) -> DataFrame:
    """Variance of every component and its share of the total."""
    scores, _ = D.principal_components(D.standardize(at.descriptors(spark, sf_dir)), 10)
    cols = [c for c in scores.columns if c.startswith("PC")]
    total = at.descriptors(spark, sf_dir).agg(F.max(F.size("features")).cast("double")).scalar()
    rows = scores.agg(*[F.var_pop(c).alias(c) for c in cols])
    return rows.select(F.posexplode(F.array(*cols)).alias("component", "variance")).select(
        "component", "variance", (F.col("variance") / total).alias("share"))


def pca_spectrum(spark, sf_dir) -> DataFrame:
    """Sum and sum of squares of all component variances: trace and squared norm of the covariance."""
    vectors = D.standardize(at.descriptors(spark, sf_dir))
    width = vectors.agg(F.max(F.size("features"))).first()[0]
    scores, _ = D.principal_components(vectors, width)
    cols = [c for c in scores.columns if c.startswith("PC")]
    found = scores.agg(*[F.var_pop(c).alias(c) for c in cols])
    return found.select(F.lit(len(cols)).cast("bigint").alias("n"), round_to(sum(F.col(c) for c in cols), 6).alias("total"),
                        round_to(sum(F.col(c) * F.col(c) for c in cols), 6).alias("squares"))


PCA_SPECTRUM = """WITH u AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
s AS (SELECT id, dim, (v - avg(v) OVER w) / stddev_pop(v) OVER w AS v FROM u WINDOW w AS (PARTITION BY dim)),
c AS (SELECT a.dim AS i, b.dim AS j, covar_pop(a.v, b.v) AS c FROM s a JOIN s b ON a.id = b.id GROUP BY ALL)
SELECT count(DISTINCT i) AS n, round(sum(c) FILTER (i = j), 6) AS total, round(sum(c * c), 6) AS squares FROM c"""


def kmeans_sizes(spark, sf_dir) -> DataFrame:
    out, _ = C.kmeans(_vectors(spark, sf_dir, 3), 4)
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def auto_eps(spark, sf_dir) -> DataFrame:
    """The 30th percentile of all pairwise distances."""
    vectors = _vectors(spark, sf_dir, 3)
    eps = P.distance_percentile(vectors)
    return vectors.agg(F.count(F.lit(1)).alias("n")).withColumn("eps", F.round(F.lit(eps), 9))


AUTO_EPS = f"""WITH {at.descriptors_sql(3)}
SELECT (SELECT count(*) FROM vectors) AS n, round(quantile_cont(sqrt((a.f1-b.f1)**2 + (a.f2-b.f2)**2 + (a.f3-b.f3)**2), 0.3), 9) AS eps
FROM vectors a JOIN vectors b ON a.id < b.id"""


def dbscan(spark, sf_dir) -> DataFrame:
    return C.dbscan(_vectors(spark, sf_dir, 3), EPS, MIN_SAMPLES).select("id", "cluster")


DBSCAN_SQL = f"""{at.descriptors_sql(3)}, near AS (
  SELECT a.id AS a, b.id AS b FROM vectors a JOIN vectors b
  ON sqrt((a.f1-b.f1)**2 + (a.f2-b.f2)**2 + (a.f3-b.f3)**2) <= {EPS}::DOUBLE),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
links AS (SELECT a, b FROM near SEMI JOIN core c ON c.id = a SEMI JOIN core d ON d.id = b),
walk AS (SELECT id, id AS root FROM core UNION SELECT b, root FROM walk JOIN links ON a = id),
parts AS (SELECT id, min(root) AS root FROM walk GROUP BY id),
named AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM parts),
border AS (SELECT b AS id, min(cluster) AS cluster FROM near JOIN named ON named.id = a ANTI JOIN core ON core.id = b GROUP BY b),
labels AS (SELECT v.id, coalesce(n.cluster, o.cluster, -1) AS cluster FROM vectors v LEFT JOIN named n USING (id) LEFT JOIN border o ON o.id = v.id)"""
DBSCAN = f"WITH RECURSIVE {DBSCAN_SQL} SELECT id, cluster FROM labels"


def cluster_summary(spark, sf_dir) -> DataFrame:
    rows = at.descriptors(spark, sf_dir, 3).withColumnRenamed("label", "cluster")
    out = C.cluster_summary(rows, ["f1", "f2", "f3"])
    return out.withColumns({c: round_to(F.col(c), 9) for c in ("f1", "f2", "f3")})


CLUSTER_SUMMARY = f"""WITH {at.descriptors_sql(3)}
SELECT label AS cluster, count(*) AS n, round(avg(f1), 9) AS f1, round(avg(f2), 9) AS f2, round(avg(f3), 9) AS f3 FROM vectors GROUP BY label"""


def maximin_pick(spark, sf_dir) -> DataFrame:
    """Five diverse structures per label."""
    rows = _vectors(spark, sf_dir, 3).withColumnRenamed("label", "cluster")
    out = S.select_maximin(rows, 5)
    return out.withColumn("selection_rank", F.col("selection_rank").cast("bigint"))


_D3 = "sqrt((v.f1-{0}f1)**2 + (v.f2-{0}f2)**2 + (v.f3-{0}f3)**2)"
MAXIMIN_PICK = f"""WITH RECURSIVE {at.descriptors_sql(3)}, c AS (SELECT label, avg(f1) AS f1, avg(f2) AS f2, avg(f3) AS f3 FROM vectors GROUP BY label),
picks AS (
  SELECT label, [arg_min(v.id, [{_D3.format('c.')}, v.id])] AS ids,
    [arg_min(struct_pack(f1 := v.f1, f2 := v.f2, f3 := v.f3), [{_D3.format('c.')}, v.id])] AS pts
  FROM vectors v JOIN c USING (label) GROUP BY label
  UNION ALL
  SELECT label, list_append(ids, nid), list_append(pts, p) FROM (
    SELECT v.label, any_value(k.ids) AS ids, any_value(k.pts) AS pts, arg_max(v.id, [g, -v.id]) AS nid,
      arg_max(struct_pack(f1 := v.f1, f2 := v.f2, f3 := v.f3), [g, -v.id]) AS p
    FROM (SELECT v.*, list_min(list_transform(k.pts, lambda q: sqrt((v.f1-q.f1)**2 + (v.f2-q.f2)**2 + (v.f3-q.f3)**2))) AS g
      FROM vectors v JOIN picks k ON k.label = v.label AND NOT list_contains(k.ids, v.id)) v JOIN picks k ON k.label = v.label
    WHERE len(k.ids) < 5 GROUP BY v.label))
SELECT unnest(ids) AS id, label AS cluster, generate_subscripts(ids, 1) - 1 AS selection_rank
FROM picks p WHERE len(ids) = (SELECT max(len(q.ids)) FROM picks q WHERE q.label = p.label)"""


def outlier_zscore(spark, sf_dir) -> DataFrame:
    cols = [f"f{i + 1}" for i in range(8)]
    return S.zscore_outliers(at.descriptors(spark, sf_dir, 8), cols, 2.5)


OUTLIER_ZSCORE = f"""WITH {at.descriptors_sql(8)}
SELECT id FROM vectors, (SELECT {", ".join(f"avg(f{i}) AS m{i}, stddev_pop(f{i}) AS s{i}" for i in range(1, 9))} FROM vectors)
WHERE {" OR ".join(f"abs(f{i} - m{i}) / s{i} > 2.5::DOUBLE" for i in range(1, 9))}"""


def outlier_distance(spark, sf_dir) -> DataFrame:
    out = S.distance_outliers(_vectors(spark, sf_dir, 3), 2.0)
    return out.select("id", round_to("mean_dist", 9).alias("mean_dist"))


OUTLIER_DISTANCE = f"""WITH {at.descriptors_sql(3)}, m AS (
  SELECT a.id, avg(sqrt((a.f1-b.f1)**2 + (a.f2-b.f2)**2 + (a.f3-b.f3)**2)) AS d FROM vectors a, vectors b GROUP BY a.id)
SELECT id, round(d, 9) AS mean_dist FROM m WHERE d > (SELECT avg(d) + 2 * stddev_pop(d) FROM m)"""


def knn_graph(spark, sf_dir) -> DataFrame:
    out = P.nearest_structures(_vectors(spark, sf_dir, 8), 15)
    return out.select("id", "neighbor", F.col("rank").cast("bigint").alias("rank"), round_to("dist", 9).alias("dist"))


_D8 = "sqrt(" + " + ".join(f"(a.f{i}-b.f{i})**2" for i in range(1, 9)) + ")"
KNN_GRAPH = f"""WITH {at.descriptors_sql(8)}
SELECT id, neighbor, rank, round(dist, 9) AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, neighbor) AS rank FROM (
    SELECT a.id, b.id AS neighbor, {_D8} AS dist FROM vectors a JOIN vectors b ON a.id <> b.id)) WHERE rank <= 15"""


def knn_affinities(spark, sf_dir) -> DataFrame:
    """Perplexity-calibrated weights on the 91 nearest structures."""
    out = P.neighbor_affinities(P.nearest_structures(_vectors(spark, sf_dir, 8), 91), 30.0)
    return out.select("id", "neighbor", round_to("dist", 9).alias("dist"), round_to("affinity", 9).alias("affinity"))


KNN_AFFINITIES = f"""WITH RECURSIVE {at.descriptors_sql(8)}, near AS (
  SELECT id, neighbor, dist, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, neighbor) AS rank FROM (
      SELECT a.id, b.id AS neighbor, {_D8} AS dist FROM vectors a JOIN vectors b ON a.id <> b.id)) WHERE rank <= 91),
rows_of AS (SELECT id, list(neighbor ORDER BY rank) AS nb, list(dist ORDER BY rank) AS dist, min(dist * dist) AS least FROM near GROUP BY id),
walk AS (
  SELECT id, 0 AS step, 0::DOUBLE AS low, 'inf'::DOUBLE AS high, 1::DOUBLE AS beta, nb, dist,
    list_transform(dist, lambda x: x * x - least) AS d FROM rows_of
  UNION ALL
  SELECT id, step + 1, CASE WHEN up THEN beta ELSE low END, CASE WHEN up THEN high ELSE beta END,
    CASE WHEN NOT up THEN (low + beta) / 2 WHEN isinf(high) THEN beta * 2 ELSE (beta + high) / 2 END, nb, dist, d
  FROM (SELECT *, ln(total) + beta * s / total > ln(30::DOUBLE) AS up FROM (
    SELECT *, list_sum(list_transform(d, lambda x: exp(-beta * x))) AS total, list_sum(list_transform(d, lambda x: x * exp(-beta * x))) AS s
    FROM walk WHERE step < 64))),
w AS (SELECT id, nb, dist, list_transform(d, lambda x: exp(-beta * x)) AS w FROM walk WHERE step = 64)
SELECT id, unnest(nb) AS neighbor, round(unnest(dist), 9) AS dist, round(unnest(list_transform(w, lambda x: x / list_sum(w))), 9) AS affinity FROM w"""


QUERIES = {
    "window_edges": (window_edges, WINDOW_EDGES),
    "contact_edges": (contact_edges, CONTACT_EDGES),
    "graph_stats": (graph_stats, GRAPH_STATS),
    "node_features": (node_features, NODE_FEATURES),
    "feature_correlation": (feature_correlation, FEATURE_CORRELATION),
    "pair_histogram": (pair_histogram, PAIR_HISTOGRAM),
    "pair_descriptor": (pair_descriptor, PAIR_DESCRIPTOR),
    "density_descriptor": (density_descriptor, DENSITY_DESCRIPTOR),
    "angular_spectrum": (angular_spectrum, ANGULAR_SPECTRUM),
    "standardize": (standardize, STANDARDIZE),
    "pca_scores": (pca_scores, None),
    "pca_variance": (pca_variance, None),
    "pca_spectrum": (pca_spectrum, PCA_SPECTRUM),
    "kmeans_sizes": (kmeans_sizes, None),
    "auto_eps": (auto_eps, AUTO_EPS),
    "dbscan": (dbscan, DBSCAN),
    "cluster_summary": (cluster_summary, CLUSTER_SUMMARY),
    "maximin_pick": (maximin_pick, MAXIMIN_PICK),
    "outlier_zscore": (outlier_zscore, OUTLIER_ZSCORE),
    "outlier_distance": (outlier_distance, OUTLIER_DISTANCE),
    "knn_graph": (knn_graph, KNN_GRAPH),
    "knn_affinities": (knn_affinities, KNN_AFFINITIES),
}
