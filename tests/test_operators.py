"""Operators against brute force, including the paths for hot groups."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.operators import clustering as C
from trajlake.operators import descriptors as D
from trajlake.operators import metrics, ordinals, pairwise, sampling, selection, training
from trajlake.operators.components import connected_components
from trajlake.operators.graphs import graph_statistics, window_edges
from trajlake.operators.profile import density_grid, histogram
from trajlake.operators.quantiles import exact_quantiles


def test_positions_equal_row_numbers(spark):
    rng = np.random.default_rng(0)
    rows = [(int(rng.integers(3)), int(rng.integers(5)), int(v)) for v in rng.permutation(400)]
    df = spark.createDataFrame(rows, "k int, b int, v int")
    order = [F.col("b"), F.col("v")]
    plain = df.withColumn("at", (F.row_number().over(W.partitionBy("k").orderBy(*order)) - 1).cast("bigint"))
    want = sorted(map(tuple, plain.collect()))
    for other in (ordinals.ranged_position(df, ["k"], order, "at"),
                  ordinals.bucketed_position(df, ["k"], {"_b": F.col("b")}, [F.col("v")], "at")):
        assert want == sorted(map(tuple, other.select(plain.columns).collect()))


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": np.where(rng.random(30_000) < 0.9, "big", "small"), "v": rng.gamma(2.0, size=30_000)})
    pdf.loc[rng.random(30_000) < 0.3, "v"] = 1.25  # copies
    probs = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = {r["k"]: r["q"] for r in exact_quantiles(spark.createDataFrame(pdf), ["k"], "v", probs).collect()}
    for k, part in pdf.groupby("k"):
        assert np.allclose(got[k], part["v"].quantile(list(probs)), rtol=1e-12)


@pytest.mark.parametrize("n,m", [(10, 4), (1000, 7), (5, 5), (3, 9), (100, 1), (57, 56)])
def test_even_picks(spark, n, m):
    df = spark.range(n).select(F.col("id"))
    got = sorted(r[0] for r in sampling.even_downsample(df, m, [F.col("id")]).collect())
    want = sorted(set(np.linspace(0, n - 1, num=m, dtype=int).tolist())) if n > m else list(range(n))
    assert got == want
    files = df.select(F.concat(F.lit("f."), "id").alias("file"), F.lit("s").alias("sim"), F.lit(None).cast("int").alias("temp"))
    got = sorted(int(r["file"][2:]) for r in sampling.pick_files(files, None, m).collect())
    if n <= m:
        want = list(range(n))
    elif m == 1:
        want = [n // 2]
    else:
        want = sorted({int(round(i * (n - 1) / (m - 1))) for i in range(m)})
    assert got == want


def test_limit_frames(spark):
    rows = [(f, i) for f, n in (("a/2", 5), ("a/1", 3), ("a/10", 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "file string, frame_idx long")
    from trajlake.functions.metadata import natural_key
    got = sorted(map(tuple, sampling.limit_frames(df, 4, 6, natural_key(F.col("file"))).collect()))
    assert got == [("a/1", 0), ("a/1", 1), ("a/1", 2), ("a/2", 0), ("a/2", 1), ("a/2", 2)]


def test_histogram_like_numpy(spark):
    v = np.random.default_rng(2).integers(0, 50, 500) / 10
    counts, edges = np.histogram(v, bins=7)
    rows = {r["bin"]: r for r in histogram(spark.createDataFrame(pd.DataFrame({"v": v})), "v", 7).collect()}
    assert [rows[i]["n"] if i in rows else 0 for i in range(7)] == counts.tolist()
    assert rows[0]["low"] == pytest.approx(edges[0]) and rows[6]["high"] == pytest.approx(edges[-1])
    one = histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).collect()
    assert len(one) == 1 and one[0]["n"] == 2


def test_density_integrates_to_one(spark):
    pdf = pd.DataFrame({"v": np.random.default_rng(3).normal(size=300), "w": 2})
    g = density_grid(spark.createDataFrame(pdf), "v", "w", margin=1.0).orderBy("grid").toPandas()
    assert np.trapezoid(g["density"], g["x"]) == pytest.approx(1.0, abs=1e-3)


def test_metrics(spark):
    pred = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (1, [4.0, float("nan"), 6.0]), (2, [0.0, 0.0, 0.0])],
                                 "frame_no long, `values` array<double>")
    ref = spark.createDataFrame([(0, [1.5, 2.0, 2.0]), (1, [4.0, 5.0, 7.0])], "frame_no long, `values` array<double>")
    both = metrics.paired_values(pred, ref)
    row = metrics.parity_metrics(both).first()
    p, r = np.array([1, 2, 3, 4, 6.0]), np.array([1.5, 2, 2, 4, 7])
    assert row["n"] == 5 and row["rmse"] == pytest.approx(np.sqrt(((p - r) ** 2).mean()))
    assert row["r2"] == pytest.approx(1 - ((p - r) ** 2).sum() / ((r - r.mean()) ** 2).sum())
    flat = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "pred double, ref double")
    assert metrics.parity_metrics(flat).first()["r2"] is None


def test_set_split_and_types(spark):
    df = spark.createDataFrame([("s", 1, i) for i in range(5)], "sim string, temp int, f int")
    got = training.split_sets(df, ["sim", "temp"], 2, [F.col("f")]).orderBy("f").collect()
    assert [r["set_id"] for r in got] == [0, 0, 0, 1, 1] and [r["frame_no"] for r in got] == list(range(5))


@pytest.mark.parametrize("chunk", [2, 100])
def test_pack_frames(spark, chunk):
    rows = [(0, i, 3 if i % 2 else 8, float(i), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for i in (3, 1, 2, 5, 4)]
    df = spark.createDataFrame(rows, "frame int, id long, type int, x double, y double, z double, fx double, fy double, fz double, c_pe double")
    packed = training.pack_frames(training.type_codes(df, ["frame"]), ["frame"], chunk).orderBy("chunk").collect()
    assert sum((r["coord"] for r in packed), [])[::3] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert sum((r["codes"] for r in packed), []) == [0, 1, 0, 1, 0] and sum(r["energy"] for r in packed) == 5.0
    assert len(packed) == (3 if chunk == 2 else 1)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (7, 7)] + [(200, i) for i in range(201, 230)]
    df = spark.createDataFrame([("a", u, v) for u, v in edges] + [("b", 5, 6)], "k string, u long, v long")
    got = {(r["k"], r["node"]): r["component"] for r in connected_components(df, ["k"]).collect()}
    assert all(got[("a", i)] == 0 for i in range(61)) and got[("a", 103)] == 100 and got[("a", 229)] == 200
    assert got[("b", 6)] == 5 and len(got) == 61 + 3 + 30 + 2


def vectors(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, features array<double>").repartition(4)


def brute_dbscan(x, eps, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    near = d <= eps
    core = near.sum(1) >= k
    label = np.full(len(x), -1)
    c = 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack = [i]
            while stack:
                p = stack.pop()
                if label[p] >= 0:
                    continue
                label[p] = c
                if core[p]:
                    stack += [q for q in np.where(near[p])[0] if label[q] < 0]
            c += 1
    return label


@pytest.mark.parametrize("case", ["blobs", "copies", "line", "noise", "wide", "five"])
def test_dbscan(spark, case):
    rng = np.random.default_rng(5)
    dims = {"five": 5, "wide": 2}.get(case, 3)
    if case == "copies":
        x = rng.integers(0, 6, (150, 3)).astype(float)
    elif case == "line":
        x = np.stack([np.arange(120) * 0.5, np.zeros(120), np.zeros(120)], 1)
    else:
        x = np.concatenate([rng.normal(m, 0.3, (40, dims)) for m in (0, 2, 4)] + [rng.random((40, dims)) * 6])
    eps, k = {"blobs": (0.4, 5), "copies": (1.0, 6), "line": (0.5, 3), "noise": (0.01, 5), "wide": (50.0, 4), "five": (0.8, 4)}[case]
    got = {r["id"]: r["cluster"] for r in C.dbscan(vectors(spark, x), eps, k).collect()}
    want = brute_dbscan(x, eps, k)
    assert [got[i] for i in range(len(x))] == want.tolist()


def test_dbscan_refines_heavy_cells(spark, monkeypatch):
    monkeypatch.setattr(C, "PAIR_BUDGET", 4)
    rng = np.random.default_rng(9)
    x = rng.random((250, 2)) * 3
    got = {r["id"]: r["cluster"] for r in C.dbscan(vectors(spark, x), 0.3, 4).collect()}
    assert [got[i] for i in range(len(x))] == brute_dbscan(x, 0.3, 4).tolist()


def test_pairwise_blocks(spark):
    x = np.random.default_rng(6).normal(size=(90, 4))
    x[10] = x[20]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    upper = d[np.triu_indices(90, 1)]
    v = vectors(spark, x)
    for block in (20, 2048):
        assert pairwise.distance_percentile(v, 30, block) == pytest.approx(np.percentile(upper, 30), abs=1e-12)
    means = {r["id"]: r["mean_dist"] for r in pairwise.mean_distances(v, 20).collect()}
    assert np.allclose([means[i] for i in range(90)], d.mean(1))
    near = pairwise.nearest_structures(v, 5, 20).collect()
    got = sorted((r["id"], r["rank"], r["neighbor"]) for r in near)
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :5]
    assert got == [(i, k + 1, int(order[i, k])) for i in range(90) for k in range(5)]
    w = pairwise.neighbor_affinities(pairwise.nearest_structures(v, 30, 20), 10.0).toPandas().groupby("id")["affinity"]
    assert np.allclose(w.sum(), 1) and np.allclose(np.exp(w.apply(lambda p: -(p * np.log(p)).sum())), 10.0, atol=1e-6)


def test_percentile_narrows(spark, monkeypatch):
    monkeypatch.setattr(pairwise, "FINAL_VALUES", 3)
    monkeypatch.setattr(pairwise, "BINS", 8)
    x = np.random.default_rng(7).normal(size=(60, 2))
    x[:25] = 0.0  # many equal distances
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))[np.triu_indices(60, 1)]
    for p in (5, 30, 77):
        assert pairwise.distance_percentile(vectors(spark, x), p, 16) == pytest.approx(np.percentile(d, p), abs=1e-12)
    assert pairwise.distance_percentile(vectors(spark, x[:1])) == 1.0


def test_pairs_work_follows_the_pairs(spark):
    """A leaf sends k rows a structure, however many leaves it meets; pairs of blocks are dealt to many tasks."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 3))
    x[100:400] = x[7]  # copies: ties go to the smaller id
    x[500] += 40
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    v = vectors(spark, x)
    groups, n = pairwise._blocked(v, 64)
    assert n == 3000 and groups._df.rdd.getNumPartitions() >= 32
    assert pairwise.distance_percentile(v, 30) == pytest.approx(np.percentile(d[np.triu_indices(3000, 1)], 30), abs=1e-12)
    near = pairwise.nearest_structures(v, 7, 200)
    assert "Window" not in near._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["id"], r["rank"], r["neighbor"]) for r in near.collect())
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :7]
    assert got == [(i, k + 1, int(order[i, k])) for i in range(3000) for k in range(7)]
    assert pairwise.nearest_structures(vectors(spark, x[:1]), 3).count() == 0
    assert pairwise.nearest_structures(v.where("id < 0"), 3).count() == 0


def test_percentile_bounds_count_what_is_skipped():
    rng = np.random.default_rng(12)
    x, y = rng.normal(size=(300, 3)), rng.normal(size=(200, 3))
    for pdf, want in ((pd.DataFrame({"bi": 0, "bj": 0, "side": False, "id": range(300), "features": list(x)}),
                       ((x[:, None] - x[None]) ** 2).sum(-1)[np.triu_indices(300, 1)]),
                      (pd.DataFrame({"bi": 0, "bj": 1, "side": [False] * 300 + [True] * 200, "id": range(500), "features": [*x, *y]}),
                       ((x[:, None] - y[None]) ** 2).sum(-1).ravel())):
        low, high = 1.0, 1.2
        out = pairwise._count_bins(low, high, 16)(pdf).set_index("bin")
        assert out.loc[-1, "n"] == (want < low).sum() and out.drop(-1)["n"].sum() == ((want >= low) & (want <= high)).sum()
        assert sum(len(v) for _, v in pairwise._tiles(pdf, low, high)) < 0.8 * len(want)


def brute_maximin(x, n):
    chosen = [int(np.argmin(np.linalg.norm(x - x.mean(0), axis=1)))]
    while len(chosen) < min(n, len(x)):
        m = np.min([np.linalg.norm(x - x[c], axis=1) for c in chosen], axis=0)
        m[chosen] = -np.inf
        chosen.append(int(np.argmax(m)))
    return chosen


def test_maximin(spark):
    x = np.random.default_rng(8).normal(size=(60, 3))
    x[5] = x[6]
    labels = np.array([0] * 30 + [1] * 27 + [2] * 2 + [-1])
    df = vectors(spark, x).join(spark.createDataFrame([(i, int(c)) for i, c in enumerate(labels)], "id long, cluster long"), "id")
    picks = selection.select_maximin(df, 4).orderBy("cluster", "selection_rank").collect()
    want = []
    for c in (0, 1, 2):
        at = np.where(labels == c)[0]
        want += [(c, r, int(at[i])) for r, i in enumerate(brute_maximin(x[at], 4))]
    assert [(p["cluster"], p["selection_rank"], p["id"]) for p in picks] == want
    assert len(picks) == sum(min(4, int((labels == c).sum())) for c in (0, 1, 2))
    assert selection.select_maximin(df, 4, include_noise=True).count() == len(want) + 1
    with pytest.raises(ValueError):
        selection.select_maximin(df.where("cluster = -1"), 2)


def test_scaling_and_components(spark):
    x = np.random.default_rng(4).normal(size=(80, 6)) @ np.random.default_rng(5).normal(size=(6, 6))
    x[:, 2] = 3.0
    rows = {r["id"]: r["features"] for r in D.standardize(vectors(spark, x)).collect()}
    z = np.array([rows[i] for i in range(80)])
    std = x.std(0)
    want = np.where(std > 1e-12, (x - x.mean(0)) / np.where(std > 1e-12, std, 1), 0)
    assert np.allclose(z, want)
    scores, ratio = D.principal_components(vectors(spark, x), 4)
    s = np.array([[r[f"PC{i + 1}"] for i in range(4)] for r in scores.orderBy("id").collect()])
    u, sv, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(np.abs(s), np.abs(u[:, :4] * sv[:4])) and np.allclose(ratio, (sv ** 2 / (sv ** 2).sum())[:4])
    assert np.allclose(s.mean(0), 0, atol=1e-9)


def test_kmeans_limits(spark):
    x = np.random.default_rng(1).normal(size=(9, 2))
    rows, _ = C.kmeans(vectors(spark, x), 20, restarts=2)
    assert rows.select("cluster").distinct().count() <= 4
    assert C.kmeans(vectors(spark, x[:1]), 3, at_least_one=True)[0].count() == 1


def test_window_edges_across_blocks(spark):
    from trajlake.operators import graphs
    df = spark.createDataFrame([(0, i) for i in range(50)] + [(1, i) for i in range(3)], "frame int, row_idx long")
    rows = graphs.look_ahead(df, ["frame"], 4, [], block_rows=7).collect()
    assert all([a["row_idx"] for a in r["ahead"]] == list(range(r["row_idx"] + 1, min(r["row_idx"] + 5, 50 if r["frame"] == 0 else 3))) for r in rows)
    assert len(rows) == 53
    assert window_edges(df, ["frame"], 3).where("frame = 1").count() == 6


def test_outliers(spark):
    df = spark.createDataFrame([(i, float(v), 1.0) for i, v in enumerate([0, 0, 0, 0, 0, 0, 0, 9])], "id long, a double, b double")
    assert [r["id"] for r in selection.zscore_outliers(df, ["a", "b"]).collect()] == [7]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("v", F.col("id") % 7)
    want = sorted(r["id"] for r in sampling.sample_rows(df.repartition(3), 0.2).collect())
    assert want == sorted(r["id"] for r in sampling.sample_rows(df.repartition(11), 0.2).collect()) and 300 < len(want) < 500
    points = {r["id"] for r in sampling.random_points(df.repartition(5), 40).collect()}
    assert points == {r["id"] for r in sampling.random_points(df.coalesce(1), 40).collect()} and len(points) == 40


def test_unequal_frames_are_listed(spark):
    from trajlake.operators.metrics import paired_values, unpaired_frames
    pred = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (1, [1.0]), (2, [0.0])], "frame_no bigint, values array<double>")
    ref = spark.createDataFrame([(0, [1.0, 2.0, 5.0]), (1, [1.0, 2.0]), (3, [0.0])], "frame_no bigint, values array<double>")
    assert {r["frame_no"] for r in paired_values(pred, ref).collect()} == {0}
    assert {tuple(r) for r in unpaired_frames(pred, ref).collect()} == {(1, 1, 2), (2, 1, None), (3, None, 1)}


def test_csv_layouts_are_read_by_their_own_header(spark, tmp_path):
    from trajlake.sources.tables import read_beads_csv, read_boxes_csv
    (tmp_path / "b").mkdir()
    (tmp_path / "b/1.csv").write_text('id,type,x,match_status\n1,2,0.5,pattern\n')
    (tmp_path / "b/2.csv").write_text('match_status,type,id,atom_indices,extra\nmanual,7,3,"[0, 2]",q\nmanual,8,4,"[1]",r\n')
    got = {(r["id"], r["type"], r["x"], r["match_status"], tuple(r["atom_indices"] or ()), r["extra"])
           for r in read_beads_csv(spark, str(tmp_path / "b")).collect()}
    assert got == {(1, 2, 0.5, "pattern", (), None), (3, 7, None, "manual", (0, 2), "q"), (4, 8, None, "manual", (1,), "r")}
    (tmp_path / "x").mkdir()
    (tmp_path / "x/1.csv").write_text("a,b,c,step\n1,2,3,10\n")
    (tmp_path / "x/2.csv").write_text("a,b,step\n4,5,20\n")
    assert {(tuple(r["cell"]), r["timestep"]) for r in read_boxes_csv(spark, str(tmp_path / "x")).collect()} == {((1.0, 2.0, 3.0), 10), ((4.0, 5.0), 20)}
