import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlab.llm.quality import (Hasher, feature_names, fit_field, forward_backward, held_out, line_features, loss_and_gradient, minimised,
                                   score_quality, train)
from basketlab.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(3)
    sizes = [4, 1, 6, 2]
    doc = np.repeat(np.arange(5), [*sizes, 0])
    score, good, bad = rng.normal(size=len(doc)) * 2, 1.3, -0.4
    p, both_good, both_bad, log_z = forward_backward(score, doc, 5, good, bad)
    for d, n in enumerate(sizes):
        own = score[doc == d]
        weights = {y: np.exp(sum(s for s, v in zip(own, y) if v) + sum(good * (a & b) + bad * (1 - a) * (1 - b) for a, b in zip(y, y[1:])))
                   for y in product((0, 1), repeat=n)}
        z = sum(weights.values())
        assert np.isclose(log_z[d], np.log(z))
        for t in range(n):
            assert np.isclose(p[doc == d][t], sum(w for y, w in weights.items() if y[t]) / z)
        assert np.isclose(both_good[d], sum(w * sum(a & b for a, b in zip(y, y[1:])) for y, w in weights.items()) / z)
        assert np.isclose(both_bad[d], sum(w * sum((1 - a) * (1 - b) for a, b in zip(y, y[1:])) for y, w in weights.items()) / z)
    assert log_z[4] == 0


def test_gradient_and_minimum():
    rng = np.random.default_rng(5)
    doc = np.repeat(np.arange(30), rng.integers(1, 6, 30))
    label = rng.integers(0, 2, 30).astype(float)
    x = np.hstack([np.ones((len(doc), 1)), rng.normal(size=(len(doc), 3)) + label[doc][:, None]])
    f = lambda t: loss_and_gradient(t, x, doc, label, 0.5)
    theta = rng.normal(size=6)
    slope = [(f(theta + 1e-5 * e)[0] - f(theta - 1e-5 * e)[0]) / 2e-5 for e in np.eye(6)]
    assert np.allclose(f(theta)[1], slope, rtol=1e-4, atol=1e-5)
    best = minimised(f, np.zeros(6), rounds=500)
    assert np.abs(f(best)[1]).max() < 0.1 and f(best)[0] <= min(f(best + 0.05 * rng.normal(size=6))[0] for _ in range(20))


def test_line_features():
    texts = ["Good words, here.\n\n  \nBAD!! BAD!! BAD!!\nGood words, here.", "", " \n", "ÉÀ é"]
    doc, weight, x = line_features(texts, Hasher(13))
    at = {n: i for i, n in enumerate(feature_names())}
    assert x.shape == (6, len(at)) and doc.tolist() == [0, 0, 0, 1, 2, 3] and weight.tolist() == [17, 17, 17, 1, 1, 7]
    assert x[:, at["blank"]].tolist() == [0, 0, 0, 1, 1, 0] and x[:, at["line_seen"]].tolist() == [0, 0, 1, 0, 0, 0]
    assert np.isclose(x[1, at["words_like_last"]], 2 / 3) and x[1, at["words_in_capitals"]] == 1 and x[1, at["upper"]] == 1
    assert x[0, at["capital_first"]] == x[0, at["stop_last"]] == 1 and np.isclose(x[0, at["upper"]], 1 / 13)
    assert np.isclose(x[5, at["upper"]], 2 / 3)
    # neighbours within the text only
    assert x[0, at["upper_behind"]] == x[2, at["upper_before"]] == 1 and x[1, at["upper_before"]] == x[0, at["upper"]]
    assert x[:, at["none_before"]].tolist() == [1, 0, 0, 1, 1, 1] and x[:, at["none_behind"]].tolist() == [0, 0, 1, 1, 1, 1]
    alone = line_features(texts[:1], Hasher(13))
    assert np.allclose(alone[2], x[:3])


def test_neighbours_decide_a_doubtful_line():
    doc = np.repeat([0, 1], 3)
    x = np.array([[1, 2.0], [1, 0], [1, 2], [1, -2], [1, 0], [1, -2]])
    m = fit_field(x, doc, np.array([1.0, 0]), penalty=0.1)
    p = forward_backward(x @ m.weights, doc, 2, m.good, m.bad)[0]
    assert p[1] > 0.8 and p[4] < 0.2


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op13_quality"](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held(i) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for i, r in got.items())
    rows = [(got[r.doc_id].predicted, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()
            if r.doc_id in got and held(r.doc_id) and r.quality is not None]
    assert len(rows) > 80 and sum(a == b for a, b in rows) / len(rows) > 0.95


DOCS = "doc_id long, text string, score string, label int"
GOOD, BAD = "Plain words make a line.\nAnd another one follows it.", "BUY!! NOW!! BUY!! NOW!!\n$$$ ### $$$"


def test_defined_cases(spark):
    learnt = [i for i in range(400) if not held(i)][:60]
    rows = [(i, (GOOD if k % 2 else BAD) + f" {k}", "s", 1) for k, i in enumerate(learnt)]
    odd = [(learnt[0], GOOD, "s", 1), (10_001, None, "s", 1), (10_002, "", "s", 1), (10_003, " \n ", "s", 1), (None, GOOD, "s", 1), (None, BAD, "s", 1),
           (10_004, "\n".join([BAD] * 3000), "s", 1), (10_005, "\x00\x1c", "s", 1)]
    labels = [(i, k % 2) for k, i in enumerate(learnt)] + [(None, 1), (77_777, 0), (learnt[3], None), (10_001, None)]
    df, lb = spark.createDataFrame(rows + odd, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")
    got = score_quality(df, lb).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {(r.doc_id, r.n_lines): r for r in got}
    assert not any(r.held_out for r in got if r.doc_id is None) and {r.predicted for r in got if r.doc_id is None} == {0, 1}
    assert by[10_004, 6000].predicted == 0 and by[10_004, 6000].good_lines == 0
    assert by[10_001, 1].score == by[10_002, 1].score == by[10_003, 1].score
    assert all(r.predicted == k % 2 for k, i in enumerate(learnt) if k for r in got if r.doc_id == i)
    # labels of held-out documents change nothing
    more = spark.createDataFrame(labels + [(i, 0) for i in range(400) if held(i)], "doc_id long, quality int")
    both = spark.createDataFrame(rows + [(i, GOOD, "s", 1) for i in range(400) if held(i)], DOCS)
    a, b = ({r.doc_id: r.score for r in score_quality(both, x).collect()} for x in (lb, more))
    assert a == b


@pytest.mark.parametrize("labels,share", [([], 0.5), ([(1, 0)], 0.0), ([(1, 1), (3, 1)], 1.0)])
def test_without_both_kinds(spark, labels, share):
    ids = [i for i in range(50) if not held(i)][:4]
    df = spark.createDataFrame([(i, GOOD, "s", 1) for i in ids], DOCS)
    lb = spark.createDataFrame([(ids[k], v) for k, v in labels], "doc_id long, quality int")
    assert {r.score for r in score_quality(df, lb).collect()} == {share}


def test_empty_and_bounded(spark):
    empty = spark.createDataFrame([], DOCS)
    assert score_quality(empty, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    ids = [i for i in range(300) if not held(i)]
    df = spark.createDataFrame([(i, (GOOD if i % 2 else BAD) + f"\n{i}" * (i % 90), "s", 1) for i in ids], DOCS)
    lb = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    m = train(df.select("doc_id", "text"), lb, max_labelled=40, max_lines=3)
    assert m.share is None and len(m.weights) == len(feature_names())
    assert [r.h for r in spark.range(30).select(held_out(F.col("id")).alias("h")).collect()] == [held(i) for i in range(30)]
