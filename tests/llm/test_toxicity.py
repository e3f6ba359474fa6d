import random

import numpy as np
import pytest

from basketlab.llm.toxicity import (SEEDS, chain_probabilities, classify, features_of, fit_chain, fit_logistic, labelled_rows,
                                    train)

PLAIN = "the of and a house river tree walks slowly over green hills while old birds sing in many quiet places".split()
BAD = ["idiot", "scum", "worthless", "lowei", "loweischaft", "vequire"]


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.3
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(BAD) + rng.choice(["", "!", ","]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus(600, 1)
    edges = [(1000, None), (1001, ""), (1002, "house " * 30000 + "scum"), (None, "an idiot"), (5, "repeated id, clean")]
    docs = spark.createDataFrame([(i, t, True) for i, t, _ in rows] + [(*e, True) for e in edges],
                                 "doc_id long, text string, toxic boolean")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:400]] + [(None, 1), (3, None), (99999, 1), (1000, None)],
                                   "doc_id long, toxic int")
    return rows, docs, labels, classify(docs, labels).collect()


def test_held_out_accuracy(scored):
    rows, _, _, got = scored
    found = {r.doc_id: r.toxic for r in got if r.doc_id is not None and r.doc_id != 5}
    held = [(found[i], bool(y)) for i, _, y in rows[400:]]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert len(got) == len(rows) + 5
    assert not found[1000] and not found[1001] and found[1002]
    assert [r.toxic for r in got if r.doc_id is None] == [True]


def test_categories(scored):
    rows, _, _, got = scored
    for name in SEEDS:
        hit = [r[f"p_{name}"] for r, in zip(r for r in got if r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5)
               if any(s in rows[r.doc_id][1] for s in SEEDS[name])]
        assert np.mean(hit) > 0.7


def test_without_labels(spark, scored):
    _, docs, labels, _ = scored
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        assert classify(docs, none).filter("toxic OR p_toxic <> 0").count() == 0
    assert classify(docs.limit(0), labels).count() == 0


def test_bound_on_labelled_rows(scored):
    _, docs, labels, _ = scored
    assert classify(docs, labels, max_labelled=60).count() == docs.count()


def test_repeated_ids_count_once(spark):
    rows = corpus(120, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(7, f"house number {k % 9} of seven") for k in range(3000)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = labelled_rows(docs, labels, "toxic", 80).collect()
    assert len(got) == len({r.doc_id for r in got}) == 80
    every = {(r.doc_id, r.text) for r in labelled_rows(docs.repartition(13), labels, "toxic", 1000).collect()}
    assert len(every) == 120 and every == {(r.doc_id, r.text) for r in labelled_rows(docs, labels, "toxic", 1000).collect()}
    once = spark.createDataFrame(sorted(every), "doc_id long, text string")
    a, b = train(docs, labels), train(once, labels)
    assert a.columns == b.columns and all(np.allclose(x, y) for x, y in zip(a.weights, b.weights))


def test_features():
    assert features_of({"lowei", "a"}) == {"lowei ", "a ", "lowe"}


def test_chain_uses_earlier_links():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (400, 2)).astype(float)
    first = x[:, 0]
    targets = np.stack([first, first], axis=1)
    weights = fit_chain(x, targets, np.arange(400) % 5)
    assert len(weights[0]) == 3 and len(weights[1]) == 4 and weights[1][3] > 0.5
    p = chain_probabilities(weights, x)
    assert ((p[:, 1] > 0.5) == (first == 1)).all()


def test_logistic_is_the_ridge_optimum():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 3)), rng.integers(0, 2, 300).astype(float)
    w = fit_logistic(x, y, penalty=2.0, rounds=50)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert abs(x.T @ (y - p) - 2.0 * w[1:]).max() < 1e-3
