"""Prefix trie of conversations, its subtree totals, the spilling queue, phrase counting and collocations."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.llm import collocations as coll
from trajlake.llm import queries
from trajlake.llm.prefix_trie import ordered_turns, prefix_hashes, prefix_trie, subtree_totals, with_shared_heads
from trajlake.llm.spill import SpillingQueue
from trajlake.llm.word_trie import WordTrie

from .tables import ODD, odd_docs
from .test_native import SF, oracle, tables

TURNS = "conv_id bigint, turn bigint, role string, text string, length int, shard int"


@tables
@pytest.mark.parametrize("name,table", [("op11_collocations", "documents"), ("op13_prefix_trie", "conversations")])
def test_query_matches_sql(spark, name, table):
    query, sql = queries.QUERIES[name]
    columns, want = oracle(sql, table)
    got = query(spark, SF).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want) and got


def test_queue_gives_all_entries_in_order(tmp_path):
    draw = random.Random(4)
    queue, held, got, want = SpillingQueue(f"file://{tmp_path}/runs", 8), [], [], []
    for _ in range(3000):
        if draw.random() < 0.6 or not held:
            entry = (draw.randrange(1000), draw.randrange(5), draw.random())
            queue.push(entry)
            held.append(entry)
        else:
            held.sort()
            assert queue.least() == held[0]
            got.append(queue.pop())
            want.append(held.pop(0))
    assert got == want and queue.spilled > 100
    queue.close()
    assert not list((tmp_path / "runs").iterdir())


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def trie_of(paths):
    members, chars = defaultdict(set), {(): 0}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
            chars[tuple(path[:d])] = len(path[d - 1][1]) if d else 0
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * chars[p]
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items())


def conversations(seed=1):
    draw, rows = random.Random(seed), []
    for c in [*range(40), *range(100, 130), 205, 299, 300, -7, -100, 10**12]:
        if c == 107:
            continue
        start = [("system", "same start"), ("user", f"q{c % 3}")][:draw.randrange(3)]
        for t, (role, text) in enumerate(start + [("user", draw.choice("abc💡") * draw.randrange(4)) for _ in range(draw.randrange(1, 9))]):
            rows.append((c, t, role, text, 1, 2))
    rows += [(10, None, None, None, None, None), (10, None, None, "null turn", 1, 1), (None, 1, "user", "of nobody", 1, 1), (11, 99, None, "x", 1, 1)]
    rows += [(60, t, "user", f"deep {t}", 1, 1) for t in range(300)] + [(61, t, "user", f"deep {t}", 1, 1) for t in range(250)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_nodes,queue", [(5, 2), (37, 4), (8192, 1000)])
def test_trie_matches_brute_force(spark, shard_nodes, queue):
    rows = conversations()
    turns = ordered_turns(spark.createDataFrame(rows, TURNS).repartition(5))
    got = prefix_trie(*with_shared_heads(turns), shard_nodes=shard_nodes, queue=queue).collect()
    assert Counter(map(tuple, got)) == trie_of(rebuilt(rows))


def test_trie_of_nothing_and_of_nobody(spark):
    for rows in ([], [(None, 1, "user", "x", 1, 1)]):
        assert prefix_trie(*with_shared_heads(ordered_turns(spark.createDataFrame(rows, TURNS)))).collect() == []


def test_running_hashes_cross_blocks(spark, monkeypatch):
    """A conversation of several blocks has the hashes that one block gives."""
    from trajlake.llm import prefix_trie as module
    paths = spark.range(500).select(F.lit(1).cast("bigint").alias("conv_id"), (F.col("id") + 1).alias("depth"), F.lit(500).cast("bigint").alias("length"),
                                    F.xxhash64("id").alias("role_text"), F.xxhash64("id", "id").alias("role_text2"), F.col("id").alias("chars"))
    want = sorted(map(tuple, prefix_hashes(paths).collect()))
    monkeypatch.setattr(module, "STEPS", 64)
    assert sorted(map(tuple, prefix_hashes(paths).collect())) == want


def test_totals_of_one_node_with_children_everywhere(spark):
    """A root with thousands of children in hundreds of shards, and a chain through all of them."""
    rows = [(0, None, 0, 3)] + [(i, 0 if i % 2 else max(0, i - 2), 1 if i % 2 or i == 2 else i // 2, 1) for i in range(1, 2001)]
    nodes = spark.createDataFrame(rows, "pos bigint, ppos bigint, depth bigint, worth bigint")
    got = {r["pos"]: tuple(r)[1:] for r in subtree_totals(nodes, shard_nodes=16, queue=10).collect()}
    assert len(got) == 2001 and got[0] == (1001, 1001, 2003) and got[2] == (1, 1, 1000) and got[2000] == (0, 1, 1) and got[5] == (0, 1, 1)


@pytest.mark.parametrize("burst,most", [(8, 40), (64, 10**6), (5, 10**6)])
def test_word_trie_counts(burst, most):
    draw = np.random.default_rng(2)
    trie, got, want = WordTrie(3, burst=burst, most=most), Counter(), Counter()
    for _ in range(12):
        at = draw.zipf(1.5, 400) % 50 + 1
        keys = trie.key([at[:-2], at[1:-1], at[2:]])
        want.update(zip(at[:-2].tolist(), at[1:-1].tolist(), at[2:].tolist()))
        for run, n in trie.add(keys):
            assert (np.diff(run) > 0).all()
            got.update(dict(zip(zip(*(w.tolist() for w in trie.words(run))), n.tolist())))
        assert len(trie) <= most
    for run, n in trie.spill():
        for phrase, count in zip(zip(*(w.tolist() for w in trie.words(run))), n.tolist()):
            got[phrase] += count
    # runs of a phrase that left several times add up
    assert sum(got.values()) <= sum(want.values()) and set(got) == set(want)
    if most > 10**5:
        assert got == want and len(trie.parts) > 1


def phrases(rows, least, percent, top):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang, *_ in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in cand.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        rows = []
        for p, a in cand.items():
            if longer[p] and 100 * longer[p] >= percent * a:
                continue
            score, _, l, r = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return Counter(out)


@pytest.mark.parametrize("limits", [{}, {"burst": 6, "most": 30, "filter_bits": 8}])
def test_collocations_match_brute_force(spark, monkeypatch, limits):
    draw = random.Random(8)
    vocabulary = ["The", "the", "cat", "sat", "on", "ñu", "É", "x-y", "mat", "💡", "and", "dog"]
    rows = [(i, "".join(draw.choice(vocabulary) + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "! "]) for _ in range(draw.randrange(120))),
             draw.choice(["en", "de", None]), "a", 1, 1, "x", 1) for i in range(60)]
    rows += [*ODD, (99, "one two " * 3000, "en", "a", 1, 1, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, a int, word string, n bigint").repartition(4)
    got = coll.collocations(docs, least=4, top=40, **limits).collect()
    assert Counter(map(tuple, got)) == phrases(rows, 4, 50, 40)


def test_slices_and_vocabularies_that_turn_over(spark, monkeypatch):
    """Small slices and vocabularies count the same."""
    def small(batches, width):
        for lang, texts in coll._chunks(batches):
            words = b".".join(texts).translate(coll.TABLE).replace(b".", b" . ").split()
            for at in range(0, len(words), 7):
                yield lang, words[at:at + 7 + width - 1], min(7, len(words) - at)

    assert [x for x in coll._slices(iter([]), 2)] == []
    run = coll._pair_runs({"burst": 50, "most": 200})
    batch = odd_docs(spark).selectExpr("coalesce(lang, 'und') lang", "coalesce(text, '') text").toArrow().combine_chunks().to_batches()

    def counts():
        out = Counter()
        for rows in run(iter(batch)):
            for w1, w2, n in zip(*(rows.column(i).to_pylist() for i in range(3))):
                out[w1, w2] += n
        return out

    want = counts()
    monkeypatch.setattr(coll, "_slices", small)
    monkeypatch.setattr(coll, "WORDS", 20)
    assert counts() == want and len(want) > 100


def test_no_phrases_in_an_empty_table(spark):
    docs = odd_docs(spark)
    assert coll.collocations(docs.limit(0)).collect() == []
    assert coll.collocations(docs, least=10**6).collect() == []
