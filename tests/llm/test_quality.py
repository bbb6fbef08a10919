"""Quality by a chain over lines: marginals against enumeration, gradients, held-out accuracy, odd rows."""
from itertools import product
from math import exp

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.llm import queries
from trajlake.llm.quality import (STATS, bad_share, binned, fit_chain, fit_quality, good_marginals, line_stats, lines_of, score_quality)

from .tables import ODD, odd_docs
from .test_native import SF, tables


def test_marginals_match_enumeration():
    draw = np.random.default_rng(1)
    for n in (1, 2, 5):
        scores, turns = draw.normal(size=n).tolist(), np.exp(draw.normal(size=4)).tolist()
        weight = np.zeros(n)
        total = 0.0
        for labels in product((0, 1), repeat=n):
            w = exp(sum(s for s, y in zip(scores, labels) if y))
            for a, b in zip(labels, labels[1:]):
                w *= turns[2 * a + b]
            total += w
            weight += w * np.array(labels)
        assert np.allclose(good_marginals(scores, turns), weight / total)


def test_long_documents_stay_finite():
    good = good_marginals([50.0] * 5000 + [-50.0] * 5000, [2.0, 0.1, 0.2, 3.0])
    assert good[0] > 0.99 and good[-1] < 0.01 and all(0 <= g <= 1 for g in good)


def test_bad_lines_are_learned_from_document_labels():
    draw = np.random.default_rng(3)
    clean = [" ".join("".join(draw.choice(list("abcdefgh"), 5)) for _ in range(12)) + "." for _ in range(300)]
    junk = [" ".join(["Hm"] * int(draw.integers(20, 40))) for _ in range(60)]
    docs, labels = [], []
    for i in range(120):
        lines = [clean[j] for j in draw.integers(0, 300, 4)]
        if i % 3 == 0:
            lines[int(draw.integers(0, 4))] = junk[int(draw.integers(0, 60))]
        docs.append("\n".join(lines))
        labels.append(int(i % 3 != 0))
    weights, turns = fit_chain([line_stats(lines_of(t)) for t in docs], np.array(labels))
    share = np.array(bad_share(docs, weights, turns))
    assert share[np.array(labels) == 0].min() > share[np.array(labels) == 1].max()
    # the bad line is told apart, not the document around it
    only = bad_share(["\n".join([clean[0], clean[1], junk[0]]), "\n".join([clean[0], clean[1], clean[2]])], weights, turns)
    size = len(junk[0]) / sum(map(len, (clean[0], clean[1], junk[0])))
    assert abs(only[0] - size) < 0.25 and only[1] < 0.1


def test_features_cover_the_whole_text():
    stats = line_stats(["ABC def", "x " * 50_000 + "#" * 100_000, "ABC def"])
    assert stats.shape == (3, STATS) and stats[0, -1] == 0 and stats[2, -1] == 1 and stats[1, 4] > 0.4
    assert binned(stats).shape == (3, STATS) and (np.diff(binned(stats), axis=1) > 0).all()
    assert lines_of(None) == lines_of(" \n\t\n") == [] and bad_share([None, "", "\n"], np.zeros((3, 1 + STATS * 11)), [1.0] * 4) == [None] * 3


@tables
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_quality(docs, fit_quality(docs, labels))
    assert scored.count() == docs.count()
    got = scored.where("held_out").join(labels.where("quality is not null"), "doc_id").collect()
    good, bad = [r for r in got if r["quality"] == 1], [r for r in got if r["quality"] == 0]
    assert sum(r["predicted"] for r in good) >= 0.9 * len(good) and sum(1 - r["predicted"] for r in bad) >= 0.8 * len(bad)
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.93 * len(got)
    query = queries.op12_quality_lines(spark, SF)
    assert {"doc_id", "held_out", "score", "predicted"} <= set(query.columns) and query.where("score < 0 or score > 1 or score is null").isEmpty()


@pytest.mark.parametrize("labels", [[], [(4, 1), (5, 1)], [(1, 0), (4, 1), (4, 0), (None, 1), (5, None), (9, 0), (10, 1), (11, 1)]])
def test_odd_rows(spark, labels):
    docs = odd_docs(spark)
    model = fit_quality(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    got = score_quality(docs, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"]: r["score"] for r in got}[1] == {r["doc_id"]: r["score"] for r in got}[2]  # null and empty
    assert score_quality(docs.limit(0), model).count() == 0
    copies = score_quality(docs.where("doc_id = 7"), model).select(F.countDistinct("score")).first()[0]
    assert copies == 1
