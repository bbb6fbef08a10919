"""WARC records and their fixity audit with Merkle trees."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.llm.common import global_rank, running_total, stored


def warc_record(key: Column, url: Column, body: Column, date: str = "1970-01-01T00:00:00Z") -> Column:
    """The bytes of one WARC 1.0 resource record, as a string column; nulls count as empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    line = "\r\n"
    return F.concat(F.lit(f"WARC/1.0{line}WARC-Type: resource{line}WARC-Record-ID: <urn:page:"),
                    F.coalesce(key.cast("string"), F.lit("")), F.lit(f">{line}WARC-Date: {date}{line}WARC-Target-URI: "),
                    url, F.lit(f"{line}Content-Type: text/html{line}Content-Length: "),
                    F.octet_length(body).cast("string"), F.lit(line * 2), body, F.lit(line * 2))


def leaf_table(records: DataFrame, key: str, record: str) -> DataFrame:
    """(key, copy, length, digest): one row per record.

    Records that repeat a key are told apart by a number, in the order of their digests.
    """
    rows = records.select(F.col(key), F.octet_length(record).cast("bigint").alias("length"),
                          F.sha2(F.encode(F.coalesce(F.col(record), F.lit("")), "UTF-8"), 256).alias("digest"))
    # identical records first become one row with a count, so a hot key stays small
    rows = rows.groupBy(key, "length", "digest").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(key).orderBy("digest").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_n").over(before), F.lit(0))
    # numbers in blocks, so that no array is as long as the copies of a hot record
    rows = rows.withColumn("_at", first).withColumn("_last", F.col("_at") + F.col("_n") - 1)
    rows = rows.withColumn("_block", F.explode(F.sequence("_at", "_last", F.lit(4096).cast("bigint"))))
    return (rows.withColumn("copy", F.explode(F.sequence("_block", F.least(F.col("_block") + 4095, "_last"))))
            .drop("_n", "_at", "_last", "_block"))


def merkle_levels(leaves: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    """(node, digest) tables of one replica's tree from the lowest ranges to the root.

    ``leaves`` is (ordinal, length, digest).  A node hashes the places and
    digests of its at most ``fanout`` children; a range without leaves has no node.
    """
    level = leaves.select(F.floor(F.col("ordinal") / fanout).alias("node"), F.col("ordinal").alias("_child"),
                          F.concat_ws("@", "digest", "length").alias("digest"))
    out = []
    for _ in range(height):
        pairs = F.array_sort(F.collect_list(F.struct(F.col("_child").cast("string").alias("at"), "digest")))
        tree = stored(level.groupBy("node").agg(F.sha2(F.concat_ws(",", F.transform(
            pairs, lambda c: F.concat_ws(":", c["at"], c["digest"]))), 256).alias("digest")))
        out.append(tree)
        level = tree.select(F.floor(F.col("node") / fanout).alias("node"), F.col("node").alias("_child"), "digest")
    return out


def differing_ranges(left: list[DataFrame], right: list[DataFrame], fanout: int) -> DataFrame:
    """(range_id) of the lowest ranges whose digests differ, found from the roots down.

    A level is compared only at the children of nodes that differ above it.
    """
    def compare(a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.join(b.withColumnRenamed("digest", "_other"), "node", "full")
        return stored(both.where(~F.col("digest").eqNullSafe(F.col("_other"))).select("node"))

    bad = compare(left[-1], right[-1])
    for a, b in zip(left[-2::-1], right[-2::-1]):
        down = bad.select(F.explode(F.sequence(F.col("node") * fanout, F.col("node") * fanout + fanout - 1)).alias("node"))
        bad = compare(a.join(down, "node", "left_semi"), b.join(down, "node", "left_semi"))
    return bad.select(F.col("node").alias("range_id"))


def fixity_audit(left: DataFrame, right: DataFrame, *, key: str, record: str, fanout: int = 16) -> DataFrame:
    """Compare two replicas of a set of records and locate what differs.

    A manifest, the ordered keys of both replicas without digests, fixes the
    ranges: ``fanout`` keys, then ``fanout`` ranges, up to one root.  Each
    replica's tree is built from its own leaves alone.  The roots are compared
    first, then only the children of nodes that differ; records of the right
    replica meet those of the left one only in the lowest ranges that differ,
    and equal range digests settle all others.  Offsets are no part of a
    digest, so one resized record does not change the ranges after it.

    One row per record of either replica: key, copy, ordinal, offset and length
    in the left replica, digest, replica_digest, range_id (the lowest range)
    and status ``intact``, ``changed``, ``missing`` (not in the right replica)
    or ``extra`` (only there; offset is where it would stand, length null).
    Repeated keys are compared in the order of their digests; null records
    count as empty; a null key is a key like any other.  Empty replicas give an
    empty result.
    """
    # the caller's key may be called like a column of ours
    a, b = [stored(leaf_table(side.select(F.col(key).alias("_key"), F.col(record).alias("_record")), "_key", "_record"))
            for side in (left, right)]
    names = a.select("_key", "copy").union(b.select("_key", "copy")).distinct()
    manifest = stored(global_rank(stored(names), ["_key", "copy"], "ordinal"))

    def placed(side: DataFrame, how: str) -> DataFrame:
        m, s = manifest.alias("m"), side.alias("s")
        same = F.col("m._key").eqNullSafe(F.col("s._key")) & (F.col("m.copy") == F.col("s.copy"))
        return m.join(s, same, how).select("m._key", "m.copy", "m.ordinal", "s.length", "s.digest")

    a = placed(a, "left").withColumn("_own", F.coalesce("length", F.lit(0)))
    a = stored(running_total(a, "_own", "ordinal", "offset").withColumn("range_id", F.floor(F.col("ordinal") / fanout)).drop("_own"))
    b = stored(placed(b, "inner").withColumn("range_id", F.floor(F.col("ordinal") / fanout)))

    height, nodes = 1, -(-manifest.count() // fanout)
    while nodes > 1:
        height, nodes = height + 1, -(-nodes // fanout)
    trees = [merkle_levels(side, fanout, height) for side in (a.where("digest IS NOT NULL"), b)]
    open_ = differing_ranges(*trees, fanout)
    opened = b.join(open_, "range_id", "left_semi").select("ordinal", F.col("digest").alias("_other"))
    rows = a.join(open_.withColumn("_open", F.lit(True)), "range_id", "left").join(opened, "ordinal", "left")
    other = F.when(F.col("_open"), F.col("_other")).otherwise(F.col("digest"))
    same = F.col("digest").eqNullSafe(F.col("replica_digest"))
    status = (F.when(same, "intact").when(F.col("replica_digest").isNull(), "missing")
              .when(F.col("digest").isNull(), "extra").otherwise("changed"))
    return rows.withColumn("replica_digest", other).select(
        F.col("_key").alias(key), "copy", "ordinal", "offset", "length", "digest", "replica_digest", "range_id", status.alias("status"))
