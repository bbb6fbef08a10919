"""The registered queries of the training-data operators, with checking SQL where SQL can express them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm.collocations import collocations
from trajlake.llm.exact_dedup import copy_groups
from trajlake.llm.fingerprints import fingerprint_documents
from trajlake.llm.language import fit_languages, fold_of, predict_languages
from trajlake.llm.minhash import near_duplicates
from trajlake.llm.mixing import mix_sources
from trajlake.llm.packing import pack_documents
from trajlake.llm.prefix_trie import ordered_turns, prefix_trie, with_shared_heads
from trajlake.llm.quality import fit_quality, score_quality
from trajlake.llm.repeats import remove_repeats
from trajlake.llm.sharding import shard_by_ring
from trajlake.llm.toxicity import fit_toxicity, score_toxicity
from trajlake.llm.warc import fixity_audit, warc_record


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_merged_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                                                           "kept_sha256")


def op2_parse_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op3_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_ring(documents(spark, sf_dir), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words_each=2, percent=80)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(documents(spark, sf_dir), keep="max")


OP5_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)"""


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record against a replica with lost, cut and overwritten bodies."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    key, body = F.col("page_id"), F.coalesce("html", F.lit(""))
    damaged = (F.when(key % 53 == 5, F.concat(F.lit("#"), F.substring(body, 2, 2_000_000_000)))
               .when(key % 59 == 3, F.left(body, F.greatest(F.length(body) - 1, F.lit(0)))).otherwise(body))
    original = pages.select("page_id", warc_record(key, F.col("url"), body).alias("record"))
    replica = pages.where(key % 61 != 7).select("page_id", warc_record(key, F.col("url"), damaged).alias("record"))
    return fixity_audit(original, replica, key="page_id", record="record").drop("copy")


def _record_sql(body: str) -> str:
    return f"""concat('WARC/1.0', nl, 'WARC-Type: resource', nl, 'WARC-Record-ID: <urn:page:', page_id, '>', nl,
  'WARC-Date: 1970-01-01T00:00:00Z', nl, 'WARC-Target-URI: ', coalesce(url, ''), nl, 'Content-Type: text/html', nl,
  'Content-Length: ', strlen({body}), nl, nl, {body}, nl, nl)"""


OP7_SQL = f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, chr(13) || chr(10) AS nl FROM pages),
q AS (SELECT *, CASE WHEN page_id % 53 = 5 THEN '#' || substr(body, 2) WHEN page_id % 59 = 3
  THEN left(body, greatest(length(body) - 1, 0)) ELSE body END AS other FROM p),
r AS (SELECT page_id, {_record_sql('body')} AS a, CASE WHEN page_id % 61 <> 7 THEN {_record_sql('other')} END AS b FROM q),
s AS (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS ordinal, strlen(a) AS length,
  sha256(a) AS digest, sha256(b) AS replica_digest FROM r)
SELECT page_id, ordinal, (sum(length) OVER (ORDER BY page_id) - length)::BIGINT AS "offset", length, digest, replica_digest,
  ordinal // 16 AS range_id, CASE WHEN replica_digest IS NULL THEN 'missing' WHEN digest = replica_digest THEN 'intact'
  ELSE 'changed' END AS status FROM s"""


def op8_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op9_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict_languages(docs, fit_languages(docs.where(fold_of() != 0)))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP11_SQL = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
s AS (SELECT c.*, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM c, (VALUES (1), (2)) v(cut) JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ') WHERE cut < c.k),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
m AS (SELECT lang, part, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS part
  FROM c WHERE k = 3) GROUP BY lang, part),
t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM b LEFT JOIN m ON m.lang = b.lang AND part = phrase WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000"""


def op12_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_quality(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*with_shared_heads(ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


# crc32 by its table of 256 remainders; nodes are lists of turns, ancestors are found along the smallest member's path
OP13_SQL = """WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda a, b: xor(a >> 1, (a & 1) * 3988292384))) AS rest),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, conv_id - conv_id % 100 AS base, xor(list_reduce([4294967295] || list_transform(
  string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda a, b: xor(a >> 8, rest[xor(a, b) % 256 + 1])), 4294967295) % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id), crc),
k AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS head FROM c LEFT JOIN c b ON b.conv_id = c.base),
p AS (SELECT t.conv_id, place - h + head + 1 AS depth, role, text FROM t JOIN k USING (conv_id) WHERE place >= h
  UNION ALL SELECT k.conv_id, place + 1, role, text FROM t JOIN k ON t.conv_id = k.base WHERE place < head),
w AS (SELECT conv_id, depth, md5(CAST(list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS VARCHAR)) AS node, length(text) AS chars,
  depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p
  UNION ALL SELECT conv_id, 0, '', 0, conv_id NOT IN (SELECT conv_id FROM p) FROM k),
x AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM w GROUP BY depth, node),
y AS (SELECT x.*, (SELECT min(q.conv_id) FROM w JOIN x q ON q.depth = w.depth AND q.node = w.node
  WHERE w.conv_id = x.conv_id AND w.depth = x.depth - 1) AS parent FROM x),
u AS (SELECT depth, parent, count(*) AS kids FROM y GROUP BY depth, parent),
z AS (SELECT y.*, coalesce(kids, 0) AS kids FROM y LEFT JOIN u ON u.parent = y.conv_id AND u.depth = y.depth + 1),
s AS (SELECT w.depth, w.node, sum((z.kids = 0)::INT) AS leaves, sum((z.n_convs - 1) * z.chars) AS saved
  FROM z JOIN w ON w.conv_id = z.conv_id AND w.depth <= z.depth GROUP BY w.depth, w.node)
SELECT z.conv_id, z.depth::BIGINT AS depth, z.parent AS parent_conv_id, n_convs, kids AS n_children, leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, ends_sha256 FROM z JOIN s USING (depth, node)"""


QUERIES = {
    "op1_merged_transforms": (op1_merged_transforms, None),
    "op2_parse_fingerprints": (op2_parse_fingerprints, None),
    "op3_ring_shards": (op3_ring_shards, None),
    "op4_minmax_near_dedup": (op4_minmax_near_dedup, None),
    "op5_exact_dedup": (op5_exact_dedup, OP5_SQL),
    "op6_source_mix": (op6_source_mix, None),
    "op7_warc_fixity": (op7_warc_fixity, OP7_SQL),
    "op8_complement_packing": (op8_complement_packing, None),
    "op9_toxicity_neighbours": (op9_toxicity_neighbours, None),
    "op10_language_centroids": (op10_language_centroids, None),
    "op11_collocations": (op11_collocations, OP11_SQL),
    "op12_quality_lines": (op12_quality_lines, None),
    "op13_prefix_trie": (op13_prefix_trie, OP13_SQL),
}
