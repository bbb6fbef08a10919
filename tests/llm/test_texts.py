"""Repeated passages, fingerprints and near duplicates against plain Python."""
import hashlib
import random

import numpy as np
import pytest

from trajlake.llm import fingerprints as fp
from trajlake.llm import repeats
from trajlake.llm.minhash import drop_near_duplicates, min_max, multipliers, near_duplicates, prefix_pairs
from trajlake.llm.repeats import remove_repeats

from .tables import ODD, odd_docs

SCHEMA = "doc_id bigint, text string"


def plain_removal(rows):
    """doc -> (bytes, removed, runs, kept hash), by looking at every window in order."""
    seen, out = set(), {}
    for doc, text in rows:
        data, runs = text.encode(), []
        for at in range(len(data) - 99):
            window = data[at:at + 100]
            if window in seen:
                if runs and at <= runs[-1][1]:
                    runs[-1][1] = at + 100
                else:
                    runs.append([at, at + 100])
            seen.add(window)
        kept, at = [], 0
        for a, b in runs:
            kept.append(data[at:a])
            at = b
        out[doc] = (len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(b"".join([*kept, data[at:]])).hexdigest())
    return out


def removal(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in df.collect()}


def test_repeats_on_edited_copies(spark):
    draw = random.Random(5)
    base = ["".join(draw.choice("abcde é") for _ in range(draw.randint(80, 700))) for _ in range(12)]
    rows = []
    for doc in range(90):
        kind, text = draw.random(), draw.choice(base)
        if kind < 0.5:  # an edited copy
            for _ in range(draw.randint(0, 4)):
                at = draw.randrange(len(text))
                text = text[:at] + draw.choice(["", "X", "yy"]) + text[at + draw.randint(0, 2):]
        elif kind < 0.7:  # a passage inside another text
            a, b = draw.choice(base), draw.choice(base)
            text = a[:draw.randint(0, 300)] + text[20:150] + b[-draw.randint(1, 300):]
        elif kind < 0.8:
            text = draw.choice(["ab", "a", "abcabd"]) * 150
        rows.append((doc * 3, text))
    df = spark.createDataFrame(draw.sample(rows, len(rows)), SCHEMA).repartition(4)
    for buckets in (1, 7):
        assert removal(remove_repeats(df, buckets=buckets)) == plain_removal(rows)


def test_repeats_on_odd_rows(spark):
    distinct = {(r[0], r[1] or "") for r in ODD}
    order = sorted(distinct, key=lambda r: (r[0] is not None, r[0] or 0))
    got = remove_repeats(odd_docs(spark)).collect()
    assert len(got) == len(ODD)
    want = plain_removal([r for r in order if r[0] is not None or r[1]])
    for r in got:
        if r["doc_id"] is not None or r["n_bytes"]:
            assert (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) == want[r["doc_id"]]
    assert remove_repeats(odd_docs(spark).limit(0)).count() == 0


def test_long_document_in_parts(monkeypatch, spark):
    draw = random.Random(8)
    text = "".join(draw.choice("abcdefgh") for _ in range(30_000))
    text = text + text[5_000:5_400] + text[100:300]
    monkeypatch.setattr(repeats, "BLOCK", 1 << 10)
    block = [(1, 0, text.encode())]
    pieces = list(repeats._pieces(block))
    assert len(pieces) > 2
    seen = set()
    for ids, keys, offsets, data, starts in pieces:
        s = repeats.strips(data, starts)
        for place, lead, n, own in zip(s["place"], s["lead"], s["starts"], s["doc"]):
            begin = place - lead - starts[own] + offsets[own]
            assert not seen & set(range(begin, begin + n))
            seen |= set(range(begin, begin + n))
    assert seen == set(range(len(text) - 99))


def test_merge_of_shards_finds_shared_windows():
    draw = np.random.default_rng(2)
    rows = draw.integers(1, 3, (40, repeats.COLUMNS)).astype(np.uint8)
    rows[20:] = rows[:20]
    rows[20:, 30] ^= 3  # equal again after column 30
    shards = [repeats.transform(rows[a:b]) for a, b in ((0, 7), (7, 25), (25, 40))]
    full = np.full(40, repeats.SPAN)
    found = repeats.merge_shards(shards, np.zeros(40, int), full, np.arange(40))
    want = [[any((rows[e, c:c + 100] == rows[i, c:c + 100]).all() for e in range(i)) for c in range(repeats.SPAN)] for i in range(40)]
    assert (found == np.array(want)).all()


def test_fingerprints_of_all_pairs(spark):
    rows = sorted({(r[0], r[1] or "") for r in ODD if r[0] is not None})
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for chunks in (1, 3, 40):
        got = {r["doc_id"]: r for r in fp.fingerprint_documents(docs, chunks=chunks).collect()}
        assert len(got) == len(rows)
        for i, (doc, text) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][1]
            half = len(text) // 2
            changed = text[:len(text) - half] + following[:half]
            own, other, after = fp.fingerprints([text]) + fp.fingerprints([changed]) + fp.fingerprints([following])
            assert got[doc]["n_chars"] == len(text)
            assert got[doc]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
            assert got[doc]["fingerprint"] == fp.written(own) and got[doc]["edited_fingerprint"] == fp.written(other)
            assert got[doc]["near_edited"] == fp.likeness(own, other) and got[doc]["near_next"] == fp.likeness(own, after)


def test_fingerprints_of_odd_rows(spark):
    assert fp.fingerprint_documents(odd_docs(spark)).count() == len(ODD)
    assert fp.fingerprint_documents(odd_docs(spark).limit(0)).count() == 0
    one = fp.fingerprint_documents(spark.createDataFrame([(1, "only one here")], SCHEMA)).first()
    assert one["near_next"] == 1.0


def test_equal_passages_have_equal_interior_phrases():
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefg ") for _ in range(2000))
    passage = word()
    names = []
    for before, after in ((0, 700), (13, 0), (500, 31)):
        text = word()[:before] + passage + word()[:after]
        x, starts = fp._mix(np.array([ord(c) for c in text], np.uint64)), np.array([0])
        levels = set()
        for _ in range(3):
            x, starts = fp.parse_level(x, starts)
            levels = set(x.tolist())
        names.append(levels)
    common = names[0] & names[1] & names[2]
    assert len(common) > 0.8 * min(map(len, names))


def test_neighbours_in_a_batch_do_not_change_a_fingerprint():
    texts = ["abc", "aaaa", "a long text with several words in it " * 30, "", "x" * 500, "abc"]
    assert fp.fingerprints(texts) == [fp.fingerprints([t])[0] for t in texts]


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def plain_components(rows, n):
    sets = {d: shingle_set(t, n) for d, t in rows}
    label = {d: d for d in sets}

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d), top(d) == d) for d in sets}


@pytest.mark.parametrize("n", [2, 5])
def test_components_of_edited_copies(spark, n):
    draw = random.Random(n)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = [draw.choice(words) for _ in range(draw.randint(1, 120))]
        for _ in range(draw.choice([1, 2, 9])):
            text = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 12))):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append((len(rows) * 2, draw.choice([" ", "\n"]).join(text)))
    rows += [(1001, ""), (1003, None), (1005, "\t")]
    draw.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), words_each=n).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == plain_components(rows, n)


def test_near_copies_of_odd_rows(spark):
    docs = odd_docs(spark)
    got = near_duplicates(docs, words_each=2).collect()
    assert len(got) == len(ODD)
    rows = {(r[0], r[1]) for r in ODD if r[0] is not None}
    want = plain_components(sorted(rows), 2)
    assert all((r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    left = drop_near_duplicates(docs, words_each=2)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {d for d, v in want.items() if v[2]} | {None}
    assert near_duplicates(docs.limit(0)).count() == 0


def test_an_id_with_several_texts_is_several_documents(spark):
    base = [f"w{i}" for i in range(40)]
    near, far, other = " ".join(base), " ".join(base[:39] + ["end"]), " ".join(f"v{i}" for i in range(40))
    rows = [(1, other), (1, near), (3, far), (5, other + " x"), (None, far + " y"), (7, near), (8, "alone"), (8, "else"), (8, None), (1, near)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 36, 1, True)] * 3 + [(3, 36, 1, False), (5, 37, 1, False), (None, 37, 1, False), (7, 36, 1, False)]
                         + [(8, 1, 8, True), (8, 1, 8, True), (8, 0, 8, True)], key=str)
    left = sorted(((r["doc_id"], r["text"]) for r in drop_near_duplicates(docs).collect()), key=str)
    assert left == sorted([(1, other), (1, near), (1, near), (8, "alone"), (8, "else"), (8, None)], key=str)
    few = spark.createDataFrame([(None, near), (None, far), (2, None)], SCHEMA)
    assert sorted(str(r["component_id"]) for r in near_duplicates(few).collect()) == ["2", "None", "None"]
    assert drop_near_duplicates(few).count() == 2


def test_min_max_agreement_estimates_similarity():
    draw = np.random.default_rng(4)
    both = draw.integers(0, 1 << 63, 4000).astype(np.uint64)
    a, b = both[:3000], np.concatenate([both[1000:3000], both[3000:]])
    factors = multipliers(400)
    same = (min_max(np.sort(a), factors) == min_max(np.sort(b), factors)).mean()
    assert abs(same - 2000 / 4000) < 0.07


def test_prefixes_keep_every_similar_pair(spark):
    draw = np.random.default_rng(9)
    base = draw.integers(0, 1 << 40, 60)
    sets = {}
    for node in range(60):
        own = np.concatenate([draw.choice(base, draw.integers(40, 60), replace=False), draw.integers(0, 1 << 40, draw.integers(0, 12))])
        sets[node] = np.unique(own.astype(np.uint64))
    rows = [(i, len(s), i % 7, bytearray(s.tobytes())) for i, s in sets.items()]
    df = spark.createDataFrame(rows, "node bigint, n bigint, component bigint, shingles binary")
    got = {(min(r["node"], r["_node"]), max(r["node"], r["_node"])) for r in prefix_pairs(df, 80).collect()}
    similar = {(a, b) for a in sets for b in sets if a < b and a % 7 != b % 7
               and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert similar and similar <= got and all(a % 7 != b % 7 for a, b in got)
