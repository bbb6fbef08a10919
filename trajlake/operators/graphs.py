"""Frames as graphs: index-window and contact edges, node features, statistics."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.functions.geometry import squared_distance
from trajlake.operators.neighbors import LENGTHS, POSITION, cell_pairs

ROW_BLOCK = 65_536
N_FEATURES = 16
# slots of the node feature vector that can be non-zero
LIVE_FEATURES = (0, 1, 2, 3, 5, 6, 8, 9)


def look_ahead(atoms: DataFrame, frame: Sequence[str], span: int, payload: Sequence[str],
               block_rows: int = ROW_BLOCK) -> DataFrame:
    """Add ``ahead``: the next ``span`` rows of the frame as structs.

    Rows are windowed per block of row numbers; the first rows of a block also
    visit the block before, so neither a join nor a whole frame is needed.
    """
    frame = list(frame)
    home = F.floor(F.col("row_idx") / block_rows)
    visits = F.when((F.col("row_idx") % block_rows < span) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))
    rows = atoms.withColumn("_home", home).withColumn("_block", F.explode(visits))
    following = W.partitionBy(*frame, "_block").orderBy("row_idx").rowsBetween(1, span)
    return (rows.withColumn("ahead", F.collect_list(F.struct("row_idx", *payload)).over(following))
            .where(F.col("_home") == F.col("_block")).drop("_home", "_block"))


def window_edges(atoms: DataFrame, frame: Sequence[str], window: int = 20,
                 both_directions: bool = True) -> DataFrame:
    """(frame, src, dst) for rows less than ``window`` apart."""
    rows = look_ahead(atoms.select(*frame, "row_idx"), frame, window - 1, [])
    edges = rows.select(*frame, F.col("row_idx").alias("src"), F.explode("ahead").alias("a")).select(
        *frame, "src", F.col("a.row_idx").alias("dst"))
    if not both_directions:
        return edges
    ends = F.array(F.struct(F.col("src"), F.col("dst")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.select(*frame, F.explode(ends).alias("e")).select(*frame, "e.src", "e.dst")


def contact_cutoff() -> Column:
    """Default contact distance: 0.3 of the shortest box edge."""
    return F.least(*[F.col(l) for l in LENGTHS]) * 0.3


def contact_edges(atoms: DataFrame, frame: Sequence[str], cutoff: float | None = None) -> DataFrame:
    """(frame, src, dst, d2) of all pairs closer than the cutoff, src < dst."""
    base = [*frame, *POSITION, *LENGTHS]
    left = atoms.select(*base, F.col("row_idx").alias("src"))
    right = atoms.select(*base, F.col("row_idx").alias("dst"))
    pairs = cell_pairs(left, right, frame, contact_cutoff() if cutoff is None else cutoff, inclusive=False, once=True)
    return pairs.where(~F.col("same_cell") | (F.col("src") < F.col("dst"))).select(
        *frame, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "d2")


def graph_statistics(atoms: DataFrame, frame: Sequence[str], window: int = 20) -> DataFrame:
    """(frame, nodes, edges, avg_degree, avg_clustering) of the contact graph
    limited to an index window.

    Two neighbours of a node ahead of it are themselves within the window, so
    triangles are found inside the look-ahead list without a join.
    """
    frame = list(frame)
    rows = look_ahead(atoms, frame, window - 1, POSITION)
    lengths = [F.col(l) for l in LENGTHS]
    limit = contact_cutoff() * contact_cutoff()

    def near(a: list[Column], b: Column) -> Column:
        return squared_distance(a, [b[p] for p in POSITION], lengths) < limit

    rows = rows.withColumn("_nb", F.filter("ahead", lambda a: near([F.col(p) for p in POSITION], a)))
    closed = F.transform("_nb", lambda j: F.struct(
        j["row_idx"].alias("node"), F.lit(1).cast("bigint").alias("degree"),
        F.size(F.filter("_nb", lambda k: (k["row_idx"] != j["row_idx"]) & near([j[p] for p in POSITION], k))).cast("bigint").alias("triangles")))
    rows = rows.withColumn("_others", closed)
    own = F.struct(
        F.col("row_idx").alias("node"), F.size("_nb").cast("bigint").alias("degree"),
        (F.aggregate("_others", F.lit(0).cast("bigint"), lambda acc, o: acc + o["triangles"]) / 2).cast("bigint").alias("triangles"))
    events = rows.select(*frame, F.explode(F.concat(F.array(own), F.col("_others"))).alias("e")).select(*frame, "e.*")
    nodes = events.groupBy(*frame, "node").agg(F.sum("degree").alias("k"), F.sum("triangles").alias("t"))
    share = F.when(F.col("k") >= 2, 2 * F.col("t") / (F.col("k") * (F.col("k") - 1))).otherwise(F.lit(0.0))
    return nodes.groupBy(*frame).agg(
        F.count(F.lit(1)).alias("nodes"), (F.sum("k") / 2).cast("bigint").alias("edges"),
        F.avg("k").alias("avg_degree"), F.avg(share).alias("avg_clustering"))


def node_features(atoms: DataFrame) -> DataFrame:
    """Add ``features``: one-hot type, then sine and cosine of each coordinate."""
    slots: list[Column] = [F.lit(0.0)] * N_FEATURES
    for t in (1, 2):
        slots[t - 1] = F.when(F.col("type") == t, 1.0).otherwise(0.0)
    for j, p in enumerate(POSITION):
        slots[2 + 3 * j], slots[3 + 3 * j] = F.sin(p), F.cos(p)
    return atoms.withColumn("features", F.array(*slots))


def feature_profile(nodes: DataFrame) -> DataFrame:
    """(feature, mean_type1, mean_type2, variance) over all nodes, population variance."""
    def of(i: int) -> Column:
        return F.col("features")[i]

    stats = nodes.agg(*[F.struct(
        F.avg(F.when(F.col("type") == 1, of(i))).alias("mean_type1"),
        F.avg(F.when(F.col("type") == 2, of(i))).alias("mean_type2"),
        F.var_pop(of(i)).alias("variance")).alias(f"f{i}") for i in range(N_FEATURES)])
    return stats.select(F.posexplode(F.array(*[f"f{i}" for i in range(N_FEATURES)])).alias("feature", "s")).select(
        F.col("feature").cast("bigint").alias("feature"), "s.*")


def feature_correlation(nodes: DataFrame) -> DataFrame:
    """(a, b, corr) for a < b; slots that are always zero have no correlation."""
    pairs = [(a, b) for a in range(N_FEATURES) for b in range(a + 1, N_FEATURES)]
    live = [(a, b) for a, b in pairs if a in LIVE_FEATURES and b in LIVE_FEATURES]
    row = nodes.agg(*[F.corr(F.col("features")[a], F.col("features")[b]).alias(f"c{a}_{b}") for a, b in live])
    cells = [F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"),
                      (F.col(f"c{a}_{b}") if (a, b) in live else F.lit(None).cast("double")).alias("corr")) for a, b in pairs]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
