"""The trie of shared conversation prefixes, its subtree totals by time-forward processing."""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trajlake.llm.common import global_rank, running_total, scratch_root, stored
from trajlake.llm.spill import SpillingQueue

SHARD = 8192  # nodes of a shard
IDS = 4096  # conversation ids of a piece of a hashed list
STEPS = 4096  # turns of a block of a running hash
QUEUE = 100_000  # messages a queue holds in memory
LEVELS = [1, 2, 3, *[n << k for k in range(1, 30) for n in (2, 3)]]  # depths whose prefixes order the chains


def ordered_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, place, role_text, role_text2, chars): the turns of each conversation from place 0, without their texts.

    Turns are ordered by number, null first; equal numbers by role, then by a
    hash of the text, so that reruns agree.  Null roles and texts are empty.
    Rows without a conversation id belong to none and are left out.  A role
    and text are known by 128 bits of hashes.  One range sort of the whole
    table: a conversation may hold any share of the rows.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = stored(turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), role_.alias("role"),
        F.xxhash64(role_, text_).alias("role_text"), F.xxhash64(F.lit(1), text_, role_).alias("role_text2"),
        F.char_length(text_).cast("bigint").alias("chars")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("role_text"), F.col("role_text2")]
    ranked = global_rank(rows, order, "_rank")
    firsts = ranked.groupBy("conv_id").agg(F.min("_rank").alias("_first"))
    return (ranked.join(firsts, "conv_id")
            .select("conv_id", (F.col("_rank") - F.col("_first")).alias("place"), "role_text", "role_text2", "chars"))


def with_shared_heads(turns: DataFrame, *, block: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(paths, conversations): each conversation rebuilt on the first turns of the first one of its block.

    ``turns`` is as ``ordered_turns`` gives it.  Conversation c takes the first
    h = crc32(c) % ``heads`` turns of c - c % ``block`` (all if it has fewer,
    none if it doesn't exist), then its own after the first h.  Paths have
    (conv_id, depth from 1, length, ...); conversations (conv_id, length), with
    those that end up without a turn.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % block,
                               "h": F.crc32(F.col("conv_id").cast("string")) % heads})
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    head = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = stored(convs.join(bases, "base", "left").withColumn("head", head).select(
        "conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    turn = ["length", "role_text", "role_text2", "chars"]
    own = (turns.join(convs, "conv_id").where("place >= h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("head") + 1).alias("depth"), *turn))
    lent = (turns.where(F.col("place") < heads - 1).withColumnRenamed("conv_id", "base")
            .join(convs.select("conv_id", "base", "head", "length"), "base").where("place < head")
            .select("conv_id", (F.col("place") + 1).alias("depth"), *turn))
    return own.unionByName(lent), convs.select("conv_id", "length")


def prefix_hashes(paths: DataFrame) -> DataFrame:
    """(conv_id, depth, length, chars, p, p2, q, q2): hashes of the turns up to each one, and of those before it.

    A prefix is known by the exclusive or of hashes of (depth, turn).  It runs
    inside blocks of ``STEPS`` turns; only totals of blocks meet in a window
    over a conversation.
    """
    paths = paths.select("conv_id", "depth", "length", "chars", F.xxhash64("depth", "role_text", "role_text2").alias("t"),
                         F.xxhash64("role_text2", "role_text", "depth").alias("t2"), F.expr(f"(depth - 1) div {STEPS}").alias("block"))
    above = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = (paths.where(F.col("length") > STEPS).groupBy("conv_id", "block").agg(F.bit_xor("t").alias("b"), F.bit_xor("t2").alias("b2"))
              .select("conv_id", "block", F.bit_xor("b").over(above).alias("b"), F.bit_xor("b2").over(above).alias("b2")))
    inside = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = paths.join(before, ["conv_id", "block"], "left")
    run = {p: F.bit_xor(t).over(inside).bitwiseXOR(F.coalesce(b, F.lit(0))) for p, t, b in (("p", "t", "b"), ("p2", "t2", "b2"))}
    return rows.withColumns(run).select("conv_id", "depth", "length", "chars", "p", "p2", F.col("p").bitwiseXOR(F.col("t")).alias("q"),
                                        F.col("p2").bitwiseXOR(F.col("t2")).alias("q2"))


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined pieces of each node; pieces of a node come one after the other."""
    names, key, digest = ["depth", "p", "p2", "ends_sha256"], None, None
    for batch in batches:
        out = []
        *keys, texts = (batch.column(c).to_pylist() for c in ("depth", "p", "p2", "ids"))
        for *here, text in zip(*keys, texts):
            if here == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = here, hashlib.sha256()
            digest.update(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], names)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, p, p2, ends_sha256) of rows (depth, p, p2, conv_id): SHA-256 of the ids in ascending order, comma-joined.

    Ids are joined in pieces of at most ``IDS`` values first.  A digest reads
    its pieces in order, so the list of one node passes through one task, as a
    stream of pieces that is never held.
    """
    node = ["depth", "p", "p2"]
    pieces = (ends.groupBy(*node, F.shiftright("conv_id", IDS.bit_length() - 1).alias("piece"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")))
    return (pieces.repartition(*node).sortWithinPartitions(*node, "piece").select(*node, "ids")
            .mapInArrow(_hash_lists, "depth bigint, p bigint, p2 bigint, ends_sha256 string"))


def trie_nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node, stored: (pos, ppos, conv_id, depth, parent_conv_id, n_convs, worth, ends_sha256).

    A node is (its smallest member, its depth), so the nodes of one smallest
    member are a chain.  Chains are put in order by their prefixes at the
    depths of ``LEVELS``, which keeps subtrees together, and ``pos`` numbers
    the nodes in that order.  ``worth`` is what a node saves by itself.
    """
    rows = stored(prefix_hashes(paths))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.lit(0).cast("bigint").alias("depth"), *[F.lit(0).cast("bigint").alias(c) for c in ("p", "p2", "q", "q2")], "n_convs", "conv_id",
        F.lit(0).cast("bigint").alias("chars"))
    nodes = rows.groupBy("depth", "p", "p2").agg(F.max("q").alias("q"), F.max("q2").alias("q2"), F.count(F.lit(1)).alias("n_convs"),
                                                 F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"))
    ends = rows.where("depth = length").select("depth", "p", "p2", "conv_id").unionByName(
        convs.where("length = 0").select(*[F.lit(0).cast("bigint").alias(c) for c in ("depth", "p", "p2")], "conv_id"))
    nodes = stored(nodes.unionByName(root).join(ends_digests(ends), ["depth", "p", "p2"], "left"))
    parents = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("p").alias("q"), F.col("p2").alias("q2"),
                                              F.col("conv_id").alias("parent_conv_id"))
    top = nodes.where("depth = 0").select((F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))  # one row
    nodes = (nodes.where("depth > 1").join(parents, ["depth", "q", "q2"])
             .unionByName(nodes.where("depth = 1").join(F.broadcast(top), "depth"))
             .unionByName(nodes.where("depth = 0"), allowMissingColumns=True))

    ways = (rows.where(F.col("depth").isin(LEVELS)).groupBy("conv_id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "p"))), lambda s: s["p"]).alias("way")))
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.count(F.lit(1)).alias("n")).join(ways, "conv_id", "left")
    chains = running_total(global_rank(stored(chains), ["way", "conv_id"], "_rank"), "n", "_rank", "nodes_before")
    chains = stored(chains.select("conv_id", (F.col("nodes_before") - F.col("first")).alias("shift")))
    above = chains.select(F.col("conv_id").alias("parent_conv_id"), F.col("shift").alias("up"))
    nodes = nodes.join(chains, "conv_id")
    nodes = (nodes.where("depth > 1").join(above, "parent_conv_id")
             .unionByName(nodes.where("depth = 1").join(F.broadcast(above.join(F.broadcast(top.select("parent_conv_id")), "parent_conv_id")),
                                                        "parent_conv_id"))
             .unionByName(nodes.where("depth = 0"), allowMissingColumns=True))
    return stored(nodes.select(
        (F.col("shift") + F.col("depth")).alias("pos"), (F.col("up") + F.col("depth") - 1).alias("ppos"), "conv_id", "depth", "parent_conv_id",
        "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("worth"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


PARTIAL = "shard bigint, target bigint, depth bigint, children bigint, leaves bigint, saved bigint, port bigint"
TOTAL = "pos bigint, children bigint, leaves bigint, saved bigint"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def _climb(shard_nodes: int, folder: str, most: int, final: bool):
    """Send subtree totals up inside each shard; nodes come in shards, deepest first.

    A node takes its children's messages from the queue, whose order is that of
    the nodes, and sends its own to its parent.  What leaves the shard is
    summed by target: with ``final`` the totals of all nodes are returned, or
    else these sums and, for each node that others send to (a port), the target
    that its subtree's total goes to.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard, sums, links = SpillingQueue(folder, most), None, {}, []

        def close():
            return [(shard, *target, *s, None) for target, s in sums.items()] + [(shard, *target, 0, 0, 0, p) for p, target in links]

        for batch in batches:
            out = []
            for pos, ppos, depth, worth, port, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                if pos // shard_nodes != shard:
                    if not final:
                        out += close()
                    shard, sums, links = pos // shard_nodes, {}, []
                ports = (pos,) if port else ()
                saved += worth
                while (near := queue.least()) is not None and near[1] == pos:
                    _, _, c, n, s, more = queue.pop()
                    children, leaves, saved, ports = children + c, leaves + n, saved + s, ports + more
                if not children and not port:
                    leaves = 1
                if final:
                    out.append((pos, children, leaves, saved))
                if ppos is not None and ppos // shard_nodes == shard:
                    queue.push((1 - depth, ppos, 1, leaves, saved, () if final else ports))
                elif not final:
                    target = (-1, -1) if ppos is None else (ppos, depth - 1)
                    c, n, s = sums.get(target, (0, 0, 0))
                    sums[target] = c + 1, n + leaves, s + saved
                    links += [(p, target) for p in ports]
            if out:
                yield _batch(out, TOTAL if final else PARTIAL)
        if not final and shard is not None:
            yield _batch(close(), PARTIAL)
        queue.close()
    return run


def _across(shard_nodes: int, folder: str, most: int):
    """Send totals up over shard roots: what each target receives from other shards, deepest targets first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, target, held = SpillingQueue(folder, most), None, None
        for batch in batches:
            out = []
            for to, depth, shard, children, leaves, saved, up, up_depth in zip(*(c.to_pylist() for c in batch.columns)):
                while (near := queue.least()) is not None and near[1:3] == (to, shard):
                    *_, n, s = queue.pop()
                    leaves, saved = leaves + n, saved + s
                if to != target:
                    if target is not None:
                        out.append((target, *held))
                    target, held = to, (0, 0, 0)
                held = held[0] + children, held[1] + leaves, held[2] + saved
                if up >= 0:
                    queue.push((-up_depth, up, to // shard_nodes, leaves, saved))
            if out:
                yield _batch(out, TOTAL)
        if target is not None:
            yield _batch([(target, *held)], TOTAL)
        queue.close()
    return run


def subtree_totals(nodes: DataFrame, *, shard_nodes: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """(pos, children, leaves, saved) of each node of a stored tree (pos, ppos, depth, worth), positions dense from 0.

    Shards are runs of ``shard_nodes`` positions.  Each shard sends totals up to
    its roots; roots of a shard with the same parent elsewhere are one vertex of
    a small tree across shards, which one task climbs with a spilling queue;
    then each shard is climbed again with what its nodes receive from outside.
    The vertices grow with the shards and the depth at their borders, not with
    the nodes.
    """
    folder = f"{scratch_root(nodes.sparkSession)}/llm-{uuid.uuid4().hex}"
    shard = F.expr(f"pos div {shard_nodes}")
    tree = nodes.select("pos", "ppos", "depth", "worth")

    def climbed(rows: DataFrame, final: bool) -> DataFrame:
        some = rows.select("pos", "ppos", "depth", "worth", "port", "children", "leaves", "saved")
        return (some.repartition(shard).sortWithinPartitions(shard, F.col("depth").desc(), "pos")
                .mapInArrow(_climb(shard_nodes, folder, queue, final), TOTAL if final else PARTIAL))

    none = {c: F.lit(0).cast("bigint") for c in ("children", "leaves", "saved")}
    ports = tree.where(F.expr(f"ppos div {shard_nodes} <> pos div {shard_nodes}")).select(F.col("ppos").alias("pos")).distinct()
    partial = stored(climbed(tree.join(ports.withColumn("port", F.lit(True)), "pos", "left")
                             .withColumn("port", F.coalesce("port", F.lit(False))).withColumns(none), False))
    links = partial.where("port is not null").select(F.col("port").alias("target"), F.col("target").alias("up"), F.col("depth").alias("up_depth"))
    vertices = partial.where("port is null and target >= 0").drop("port").join(links, "target")
    outside = (vertices.select("target", "depth", "shard", "children", "leaves", "saved", "up", "up_depth")
               .repartition(1).sortWithinPartitions(F.col("depth").desc(), "target", "shard")
               .mapInArrow(_across(shard_nodes, folder, queue), TOTAL))
    rows = tree.join(stored(outside), "pos", "left").withColumn("port", F.col("children").isNotNull())
    return climbed(rows.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in none}), True)


def prefix_trie(paths: DataFrame, convs: DataFrame, *, shard_nodes: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """One row per distinct prefix of the conversations, with its members, children, leaves and what sharing it saves.

    ``paths`` and ``convs`` are as ``with_shared_heads`` gives them; any other
    paths with dense depths do as well.  The textless root is a node; an empty
    table has none.  Repeated conversations share all their nodes.
    """
    nodes = trie_nodes(paths, convs)
    totals = subtree_totals(nodes, shard_nodes=shard_nodes, queue=queue)
    return nodes.join(totals, "pos").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "ends_sha256")
