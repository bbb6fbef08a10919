"""Ring sharding, exact deduplication and fixity audit."""
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from trajlake.llm import queries
from trajlake.llm.exact_dedup import copy_groups, drop_copies
from trajlake.llm.sharding import ring_plan, shard_by_ring, virtual_nodes
from trajlake.llm.warc import differing_ranges, fixity_audit, leaf_table, merkle_levels

from .tables import ODD, odd_docs

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def oracle(sql, *names):
    con = duckdb.connect()
    for name in names:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


@tables
@pytest.mark.parametrize("name,table", [("op5_exact_dedup", "documents"), ("op7_warc_fixity", "pages")])
def test_query_matches_sql(spark, name, table):
    query, sql = queries.QUERIES[name]
    columns, want = oracle(sql, table)
    got = query(spark, SF).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want) and got


def test_groups_on_odd_rows(spark):
    docs = odd_docs(spark)
    got = copy_groups(docs, keep="max").collect()
    assert len(got) == len(ODD)
    by_text = defaultdict(list)
    for row in ODD:
        by_text[row[1] or ""].append(row[0])
    want = Counter()
    for ids in by_text.values():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep) for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == want


@pytest.mark.parametrize("keep", ["min", "max"])
def test_drop_copies_leaves_one_of_each(spark, keep):
    docs = odd_docs(spark)
    got = drop_copies(docs, keep=keep)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(r["text"] or "" for r in rows) == sorted({t or "" for _, t, *_ in ODD})
    originals = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in originals for r in rows)
    assert drop_copies(docs.limit(0)).count() == 0 and copy_groups(docs.limit(0)).count() == 0


def check_ring(spark, docs, shards):
    rows = shard_by_ring(docs, shards).collect()
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_ring_counts_and_slots(spark):
    rows = check_ring(spark, odd_docs(spark), 4)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in ODD)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert shard_by_ring(odd_docs(spark).limit(0), 4).count() == 0


def test_hot_text_and_group_stay_in_few_shards(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("t"), (F.col("id") / 6).cast("int"))).alias("text"))
    rows = check_ring(spark, docs, 40)
    again = shard_by_ring(docs.repartition(7), 40).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}
    groups = defaultdict(set)
    for r in rows:
        groups[r["text_crc32"]].add(r["shard"])
    # a group is cut only where a shard filled up
    assert sum(len(s) - 1 for s in groups.values()) <= 60


def test_plan_equals_walking_the_ring():
    points = virtual_nodes(5, 3)
    owners = [s for _, s in points] + [points[0][1]]
    counts = [(7 * i) % 5 for i in range(len(owners))]
    capacity = [-(-sum(counts) // 5)] * 5
    room, want = list(capacity), []
    rows = [arc for arc, n in enumerate(counts) for _ in range(n)]
    late = []
    for rank, arc in enumerate(rows):
        if room[owners[arc]]:
            room[owners[arc]] -= 1
            want.append((rank, owners[arc]))
        else:
            late.append((rank, arc))
    for rank, arc in late:
        while not room[owners[arc]]:
            arc = (arc + 1) % len(owners)
        room[owners[arc]] -= 1
        want.append((rank, owners[arc]))
    got = [(r, shard) for _, a, b, shard, _ in ring_plan(counts, owners, capacity) for r in range(a, b + 1)]
    assert sorted(got) == sorted(want)


def test_audit_of_odd_replicas(spark):
    schema = "k bigint, r string"
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "n"), (3, "c"), (4, "d")], schema)
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, ""), (None, "n"), (4, "dd"), (5, "e")], schema)
    got = Counter((r["k"], r["status"]) for r in fixity_audit(left, right, key="k", record="r", fanout=2).collect())
    assert got == Counter([(1, "intact"), (1, "changed"), (2, "intact"), (None, "intact"), (3, "missing"), (4, "changed"), (5, "extra")])
    assert fixity_audit(left.limit(0), right.limit(0), key="k", record="r").count() == 0
    same = fixity_audit(left, left, key="k", record="r", fanout=2).collect()
    assert {r["status"] for r in same} == {"intact"} and [r["offset"] for r in sorted(same, key=lambda r: r["ordinal"])] == [0, 1, 2, 3, 3, 4]


def test_descent_opens_only_damaged_ranges(spark):
    leaves = spark.range(1000).select(F.col("id").alias("ordinal"), F.lit(5).alias("length"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    other = leaves.where("ordinal <> 998").withColumn("digest", F.when(F.col("ordinal").isin(3, 500), F.lit("x")).otherwise(F.col("digest")))
    trees = [merkle_levels(side, 4, 5) for side in (leaves, other)]
    assert sorted(r[0] for r in differing_ranges(*trees, 4).collect()) == [0, 125, 249]
    assert differing_ranges(trees[0], merkle_levels(leaves.repartition(7), 4, 5), 4).count() == 0


def test_copies_of_a_hot_record_are_numbered_without_gaps(spark):
    rows = spark.range(10_000).select(F.lit(1).alias("k"), F.when(F.col("id") == 0, "b").otherwise("a").alias("r"))
    got = leaf_table(rows, "k", "r").agg(F.count_distinct("copy"), F.min("copy"), F.max("copy")).first()
    assert tuple(got) == (10_000, 0, 9_999)


def test_audit_of_a_key_called_like_a_column(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "digest int, length string")
    right = spark.createDataFrame([(1, "a"), (2, "x"), (3, "d")], "digest int, length string")
    got = {r[0]: r["status"] for r in fixity_audit(left.withColumnRenamed("digest", "_own"), right.withColumnRenamed("digest", "_own"),
                                                   key="_own", record="length", fanout=2).collect()}
    assert got == {1: "intact", 2: "changed", 3: "extra", None: "missing"}
