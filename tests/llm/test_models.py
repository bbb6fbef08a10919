"""Language identification and toxicity: held-out accuracy, exact search, odd rows."""
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.llm import toxicity
from trajlake.llm.language import fit_languages, fold_of, ngram_counts, predict_languages
from trajlake.llm.toxicity import ToxicityModel, drop_toxic, fit_toxicity, score_toxicity

from .tables import ODD, odd_docs

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@tables
def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = predict_languages(docs, fit_languages(docs.where(fold_of() != 0))).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_languages_of_odd_rows(spark):
    docs = odd_docs(spark)
    model = fit_languages(docs.where(fold_of() != 0))
    got = {(r["doc_id"]): r for r in predict_languages(docs, model).collect()}
    assert set(model.langs) <= {"en", "de", "fr", "es"}
    assert {got[d]["lang_pred"] for d in (1, 2, 3, 13, None)} <= {"und", *model.langs}
    assert all(got[d]["lang_pred"] == "und" for d in (1, 2, 3, 13)) and got[7]["lang_pred"] in model.langs
    assert predict_languages(docs.limit(0), model).count() == 0
    empty = fit_languages(docs.limit(0))
    assert {r["lang_pred"] for r in predict_languages(docs, empty).collect()} == {"und"}
    assert len(ODD) == predict_languages(docs, model).count()


def test_counts_cover_whole_texts():
    assert ngram_counts(None) is None and ngram_counts("12 !") is None
    text = "ab" * 50_000
    counts = ngram_counts(text)
    assert counts.sum() == 3 * len(text) - 3


@tables
def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = score_toxicity(docs, fit_toxicity(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right >= 0.9
    assert got.where("score < 0 or score > 1").count() == 0


def test_block_search_equals_brute_force():
    draw = random.Random(6)
    terms = {f"t{i}": i for i in range(30)}
    vectors = []
    for _ in range(500):
        at = draw.sample(range(30), draw.randint(1, 5))
        w = np.zeros(30)
        w[at] = [draw.random() + 0.1 for _ in at]
        vectors.append(w / np.linalg.norm(w))
    model = ToxicityModel(terms, np.linspace(1, 3, 30), list(range(500)), np.array([i % 2 for i in range(500)], float), np.ones(500),
                          np.array(vectors).T, 0.1, k=7)
    for _ in range(200):
        query = tuple(sorted((t, draw.randint(1, 4)) for t in draw.sample(range(30), draw.randint(1, 4))))
        at, w = model.weigh(query)
        cosine = w @ model.weights[at]
        want = sorted((-round(float(c), 12), i) for i, c in enumerate(cosine) if c > 0)[:7]
        assert model.nearest(query) == [(-c, i) for c, i in want]


def test_texts_looked_up_together(monkeypatch):
    """All texts of a batch share one look-up; what a task forgets it learns again, examples travel packed."""
    draw = random.Random(8)
    words = [f"{draw.choice('abcd')}{draw.choice(['', 'word', 'longer', chr(0x1F600)])}{i}" for i in range(120)]
    texts = [None, "", "...", "\ud800 half", *[" ".join(draw.choices(words, k=draw.randint(1, 300))) for _ in range(60)]]
    names = np.unique(toxicity.term_hashes(words[::2])[0])
    model = ToxicityModel.without_examples(names)

    odd = ["", "...", "a", "abcd", "(abcde)", "abcdef!", "\ud800longer", *words]
    hashes, sizes = toxicity.term_hashes(odd)
    assert sizes.tolist() == [len(toxicity.terms_of(w)) for w in odd]
    assert hashes.tolist() == [h for w in odd for h in np.array([toxicity.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))
                                                                 for x in toxicity.terms_of(w)], np.uint64).view(np.int64).tolist()]

    def plain(text):
        counts = Counter()
        for w in toxicity.words_of(text):
            counts.update(h for h in toxicity.term_hashes([w])[0].tolist() if h in names)
        return sorted((int(np.searchsorted(names, h)), n) for h, n in counts.items())

    want = [plain(t) for t in texts]
    for memo in (1000, 10):
        monkeypatch.setattr(toxicity, "WORDS", memo)
        got = [f for i in range(0, len(texts), 16) for f in model.vectors(texts[i:i + 16])]
        assert [list(zip(at.tolist(), n.tolist())) for at, n in got] == want
    assert list(zip(*(x.tolist() for x in model.vector(texts[9])))) == want[9]
    assert Counter(model.terms_once(texts).tolist()) == Counter(t for w in want for t, _ in w)
    some = [(at, n) for at, n in got if len(at)]
    packed = toxicity.PackedCounts(*map(list, zip(*[toxicity._pack(at, n) for at, n in some])))
    counts = packed.unpacked()
    assert counts.size.tolist() == [len(at) for at, _ in some]
    assert np.array_equal(counts.term, np.concatenate([at for at, _ in some])) and np.array_equal(counts.n, np.concatenate([n for _, n in some]))


def test_terms_are_hashed_once_however_they_are_written(monkeypatch):
    """A term is named and hashed when first seen, not for each form with other marks around it."""
    words, marks, hashed = ["alpha", "beta", "gammarays", "of"], ["", ",", ".", "!", "...", ");", "\u201d"], []
    plain = toxicity._hashes
    model = ToxicityModel.without_examples(np.unique(toxicity.term_hashes(words)[0]))
    monkeypatch.setattr(toxicity, "_hashes", lambda terms: hashed.extend(terms) or plain(terms))
    texts = [" ".join(f"{random.Random(i).choice(marks[1:])}{w}{m}" for w in words for m in marks) for i in range(40)]
    got = model.vectors(texts) + model.vectors(texts)
    assert sorted(hashed) == sorted(t for w in words for t in toxicity.terms_of(w))
    assert all(n.tolist() == [len(marks)] * len(hashed) for _, n in got)


def test_words_cut_as_python_cuts_them(monkeypatch):
    """Spaces, edges and lower case of all kinds of text, across pieces, equal to ``terms_of`` the words of the text."""
    draw = random.Random(4)
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    letters = ["a", "B", "9", "-", "'", "(", "\u00ab", "\u2026", "\u0130", "\u03a3", "\u4e2d", "\U0001f600", "\ud800", "\x00", "\u200b", "_"]
    texts = ["", None, "...", "x" * 700, *["".join(draw.choices(letters * 3 + spaces, k=draw.randint(1, 400))) for _ in range(80)]]
    names = sorted({t for text in texts for w in toxicity.words_of(text) for t in toxicity.terms_of(w)})
    terms = {t: i for i, t in enumerate(names[::2])}
    want = [Counter(terms[t] for w in toxicity.words_of(text) for t in toxicity.terms_of(w) if t in terms) for text in texts]
    for piece, memo in ((1 << 17, 1 << 20), (50, 30)):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        monkeypatch.setattr(toxicity, "WORDS", memo)
        model = ToxicityModel.without_examples(np.zeros(0, np.int64))
        model.terms = terms
        for _ in range(2):
            assert [dict(zip(at.tolist(), n.tolist())) for at, n in model.vectors(texts)] == want


def test_toxicity_of_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, None), (5, 0), (7, 0), (8, 1), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    for some in (labels, labels.limit(0)):
        model = fit_toxicity(docs, some)
        got = score_toxicity(docs, model).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
        assert drop_toxic(docs, model).columns == docs.columns
    assert score_toxicity(docs.limit(0), fit_toxicity(docs.limit(0), labels)).count() == 0


def test_words_that_mark_toxic_texts_are_learned(spark):
    rows = [(i, f"plain words number {i % 7} and {'stupid ' * (i % 3)}more" if i % 5 == 0 else f"plain words number {i % 7} and more") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int("stupid" in t)) for i, t in rows], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}
    assert got == {i: int("stupid" in t) for i, t in rows}


def test_rare_and_ambiguous_toxic_words_are_found(spark):
    rows, toxic = [], {}
    for i in range(600):
        a, b = i % 5 in (0, 1), i % 5 in (1, 2)  # toxic only together: each word alone is half clean
        rows.append((i, f"plain words number n{i % 7} {'left' if a else ''} {'right' if b else ''} more"))
        toxic[i] = int(a and b)
    rows += [(600 + i, f"schmutz{i} worte nummer{i} zeile{i}") for i in range(4)]
    rows += [(700 + i, f"schmutz{i % 4} worte nummer{i % 4} zeile{i % 4} ende") for i in range(60)]
    toxic |= {600 + i: 1 for i in range(4)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(docs, fit_toxicity(docs, labels, k=3)).collect()}
    assert {d: got[d]["predicted"] for d in range(600)} == {d: toxic[d] for d in range(600)}
    learned = [i for i in range(4) if not got[600 + i]["held_out"]]
    assert learned and all(got[700 + i]["predicted"] == 1 and got[700 + i]["evidence"] for i in range(60) if i % 4 in learned)


def test_clean_texts_have_neighbours_too(spark):
    rows = [(i, f"word{i} word{i + 1} common {'stupid' if i % 4 == 0 else ''}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int("stupid" in t)) for i, t in rows], "doc_id bigint, toxic int")
    assert all(len(r["evidence"]) == 3 for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect())


def test_search_over_short_and_long_lists_equals_brute_force():
    draw = np.random.default_rng(8)
    dense = np.zeros((700, 900))
    for e in range(900):
        at = np.unique(np.minimum(draw.zipf(1.3, 30) - 1, 699))
        dense[at, e] = draw.random(len(at)) + 0.1
    dense /= np.linalg.norm(dense, axis=0)
    model = ToxicityModel({f"t{i}": i for i in range(700)}, np.ones(700), list(range(900)), np.zeros(900), np.ones(900), dense, 0.1, k=9)
    model.prepare()
    assert 0 < len(model.block_max) < 700
    queries = [(at := np.unique(np.minimum(draw.zipf(1.3, 20) - 1, 699)), model.unit(at, np.ones(len(at)))) for _ in range(100)]
    for (at, w), got in zip(queries, model.search(queries)):
        want = sorted((-round(float(c), 12), i) for i, c in enumerate(w @ dense[at]) if c > 0)[:9]
        assert [i for _, i in got] == [i for _, i in want] and np.allclose([c for c, _ in got], [-c for c, _ in want], atol=1e-11)


def test_examples_of_one_language_share_blocks():
    """Blocks hold alike examples, so a text opens few of them; results are those of brute force."""
    draw, dense = np.random.default_rng(9), np.zeros((600, 1536))
    for e in range(1536):
        at = np.unique(200 * (e % 3) + np.minimum(draw.zipf(1.2, 40) - 1, 199))
        dense[at, e] = draw.random(len(at)) + 0.1
    dense /= np.linalg.norm(dense, axis=0)
    model = ToxicityModel({f"t{i}": i for i in range(600)}, np.ones(600), list(range(1536)), np.zeros(1536), np.ones(1536), dense, 0.1, k=9)
    model.prepare()
    index, opened = model.index, []
    assert np.mean([len(set(index.label[b:b + toxicity.BLOCK] % 3)) for b in range(0, 1536, toxicity.BLOCK)]) <= 2
    plain = index._open
    index._open = lambda cosine, far, wanted: opened.append(wanted.sum()) or plain(cosine, far, wanted)
    queries = [(at := np.unique(200 * (i % 3) + np.minimum(draw.zipf(1.2, 30) - 1, 199)), model.unit(at, np.ones(len(at)))) for i in range(90)]
    for (at, w), got in zip(queries, model.search(queries)):
        want = sorted((-round(float(c), 12), i) for i, c in enumerate(w @ dense[at]) if c > 0)[:9]
        assert [i for _, i in got] == [i for _, i in want] and np.allclose([c for c, _ in got], [-c for c, _ in want], atol=1e-11)
    assert sum(opened) < 0.7 * len(queries) * index.blocks
