"""Source mix, packing and the pipeline."""
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trajlake.llm import mixing, packing

from .tables import ODD, odd_docs

SF = "/root/testdata/sf0.001"
VOCABULARY = os.path.exists("/opt/tokenizers/byte_bpe_50k.json")


def test_shares_stop_at_the_limit():
    shares = mixing.share_out([10, 1000, 0, 100], [5, 2, 1, 5], 1500, 2.0)
    assert shares[0] == 20 and shares[3] == 200 and shares[2] == 0
    assert shares[1] == pytest.approx(1280)
    assert mixing.share_out([], [], 0, 2.0) == [] and mixing.share_out([0], [5], 0, 2.0) == [0.0]


def test_pairing_keeps_the_sum_and_the_expectation():
    # the sum goes first: the last small documents give up part of their expectation to it
    for sizes, near, last in (([900, 50, 50, 7, 3, 3, 1], 0.04, 0.04), ([40] * 10, 0.04, 0.04), ([60, 50, 50, 40, 30, 30, 20, 9, 9, 5, 3, 2, 1, 1], 0.05, 0.2)):
        sizes = np.array(sizes)
        total = np.zeros(len(sizes))
        for seed in range(3000):
            out, held = mixing.pair_off(sizes, np.full(len(sizes), 0.4), np.arange(len(sizes)), seed)
            assert (out * sizes).sum() == pytest.approx(0.4 * sizes.sum())
            assert sum(0 < p < 1 for p in out) == (held >= 0)
            total += out
        off = np.abs(total / 3000 - 0.4)
        assert off[sizes >= 20].max() < near and off.max() < last


def plain_pairing(sizes, parts, keys, seed):
    """The rounding with every part written out after every step."""
    parts = [float(p) for p in parts]
    for i, a in enumerate(sizes):
        later = [j for j in range(i + 1, len(sizes)) if 0 < parts[j] < 1]
        if not 0 < parts[i] < 1:
            continue
        held, space = sum(sizes[j] * parts[j] for j in later), sum(sizes[j] * (1 - parts[j]) for j in later)
        p, draw = parts[i], mixing._draw(int(keys[i]), seed)
        can = ((1 - p) * a <= held + 1e-6, p * a <= space + 1e-6)
        if can == (False, False):
            rises = draw * (held + space) < space
            parts[i] += held / a if rises else -space / a
            for j in later:
                parts[j] = 0.0 if rises else 1.0
            break
        rises = draw < p if all(can) else can[0]
        for j in later:
            parts[j] = parts[j] * (1 - (1 - p) * a / held) if rises else 1 - (1 - parts[j]) * (1 - p * a / space)
            parts[j] = 0.0 if parts[j] < 1e-9 else 1.0 if parts[j] > 1 - 1e-9 else parts[j]
        parts[i] = 1.0 if rises else 0.0
    return parts


def test_pairing_equals_the_plain_rounding():
    draw = np.random.default_rng(5)
    for seed in range(300):
        n = int(draw.integers(1, 30))
        sizes = np.sort(draw.integers(1, 2000, n))[::-1]
        parts = draw.uniform(0.05, 0.95, n) if seed % 2 else np.full(n, draw.uniform(0.05, 0.95))
        got, _ = mixing.pair_off(sizes, parts, np.arange(n) * 977, seed)
        assert got == pytest.approx(plain_pairing(sizes, parts, np.arange(n) * 977, seed), abs=1e-6)


def test_small_documents_settle_the_rest():
    draw = np.random.default_rng(1)
    for seed in range(200):
        sizes = np.sort(np.concatenate([draw.integers(1000, 6000, 4), draw.integers(1, 300, 60)]))[::-1]
        out, held = mixing.pair_off(sizes, np.full(len(sizes), draw.uniform(0.1, 0.9)), np.arange(len(sizes)), seed)
        assert held < 0 or sizes[held] <= 60


def test_mix_meets_its_targets(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', int(1 + pmod(xxhash64(id), 60)))").alias("text"),
                                    F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"))
    rows = mixing.mix_sources(docs, bucket=64).collect()
    again = mixing.mix_sources(docs.repartition(9), bucket=64).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert all(r["source_size"] == size[r["source"]] for r in rows)
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))


def test_mix_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = mixing.mix_sources(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d, len((t or "").encode().split())) for d, t, *_ in ODD)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    mixed = mixing.apply_mix(docs, mixing.mix_sources(docs))
    assert mixed.columns == docs.columns
    got = Counter(r["doc_id"] for r in mixed.collect())
    want = {r["doc_id"]: r["copies"] for r in rows if r["doc_id"] not in (None, 7)}
    assert all(got[d] == n for d, n in want.items())


def check_packing(rows, length):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


def test_exact_complements_are_found():
    fills, left = packing.exact_fills({10: 2, 7: 1, 3: 1, 5: 1, 4: 1, 1: 5, 9: 1}, 10)
    assert all(sum(members) == 10 for members, _ in fills)
    used = Counter()
    for members, times in fills:
        for m in members:
            used[m] += times
    assert used + left == Counter({10: 2, 7: 1, 3: 1, 5: 1, 4: 1, 1: 5, 9: 1})
    assert ((7, 3), 1) in fills and ((9, 1), 1) in fills and ((5, 4, 1), 1) in fills
    assert packing.exact_fills({9: 1, 5: 1, 4: 1, 2: 1}, 20)[0] == [((9, 5, 4, 2), 1)]


def test_plan_is_near_the_least_number():
    draw = np.random.default_rng(0)
    counts = Counter(draw.integers(1, 900, 5000).tolist())
    runs = packing.plan_sequences(counts, 1024)
    n = len({s + i for _, a, b, s, _ in runs for i in range(b - a + 1)})
    assert n <= 1.01 * -(-sum(k * v for k, v in counts.items()) // 1024)
    covered = Counter()
    for size, a, b, _, _ in runs:
        covered[size] += b - a + 1
    assert covered == counts


@pytest.mark.skipif(not VOCABULARY, reason="vocabulary files not present")
def test_pieces_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = packing.pack_documents(docs, length=64).collect()
    assert check_packing(rows, 64) >= 1
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.tokenizer_path())
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc, text in {(d, t) for d, t, *_ in ODD if d is not None}:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc]})
        at = 0
        for i, (piece, start, size, crc) in enumerate(own):
            assert (piece, start) == (i, at) and crc == zlib.crc32(ids[at:at + size].tobytes())
            assert size == 64 or i == 0 and (len(ids) <= 64 or size == len(ids) % 64)
            at += size
        assert at == len(ids)
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.skipif(not VOCABULARY, reason="vocabulary files not present")
def test_remembered_words_equal_whole_texts():
    tokens = packing.WordMemoTokenizer(packing.tokenizer_path())
    odd = ["", " ", "a  b", "foo.. bar,, x", " lead", "trail ", "a\n\nb", "it's 3.14, ok.", "<|endoftext|> hi", "\x00a b", "éa. ñ,z",
           "a \n b", "!!.. ,", "\t x", "“q”, (a). b", "x  y", "ａ．, b", "a!.b!,c", "\n", ".", "..", "a.\n.b", "1,000.5", "a\x1c b"]
    for text in odd + odd:
        assert np.frombuffer(tokens.encode(text), "<u4").tolist() == tokens.whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.skipif(not (VOCABULARY and os.path.isdir(SF)), reason="test tables or vocabulary files not present")
def test_pipeline_stages_on_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = corpus_pipeline.stored(docs)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
    n = {name: df.count() for name, df in kept.items()}
    assert n["documents"] > n["toxicity"] >= n["exact_dedup"] >= n["near_dedup"] > 0
    texts = [r[0] for r in kept["exact_dedup"].select("text").collect()]
    assert len(texts) == len(set(texts)) == kept["toxicity"].select("text").distinct().count()
    assert check_packing(kept["packing"].collect(), 2048)
    assert {r[0] for r in kept["packing"].select("doc_id").distinct().collect()} == {
        r[0] for r in kept["source_mix"].select("doc_id").distinct().collect()}


def test_stages_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, 0), (4, 1), (4, None), (5, 0), (None, 1)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (odd_docs(spark), odd_docs(spark).limit(0)):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1] + corpus_pipeline.STAGES[-1:] * VOCABULARY:
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
            if name != "packing":
                assert docs.columns == start.columns


def test_near_dedup_stage_takes_five_words(spark):
    words = [f"w{i}" for i in range(25)]
    other = [*words[:12], "changed", *words[13:]]  # 22 of 26 two-word and 16 of 26 five-word shingles are shared
    last = [f"v{i}" for i in range(25)]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words) + " "), (4, " ".join(last)), (5, " ".join([*last, "more"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {1, 2, 4}


def test_mixed_rows_keep_null_and_repeated_ids(spark):
    """Every row is taken as often as its own line of the mix says, whatever its id."""
    rows = [(1, "one two three", None, "a", 1, "x"), (1, "four five", None, "a", 1, None), (None, "six seven eight", "en", "a", 1, "x"),
            (None, None, None, None, None, None), (2, "same row", "en", "b", 1, "x"), (2, "same row", "en", "b", 1, "x"), (3, "", "en", "b", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, copies string").repartition(3)
    got = Counter(tuple(r) for r in mixing.mix_documents(docs).collect())
    want = Counter()
    for r in mixing.mix_sources(docs, carry=[F.coalesce("text", F.lit("")).alias("t")]).collect():
        want[r["doc_id"], r["t"]] += r["copies"]
    assert mixing.mix_documents(docs).columns == docs.columns
    seen = Counter()
    for row, n in got.items():
        seen[row[0], row[1] or ""] += n
    assert seen == +want and any(i is None for i, _ in seen)
