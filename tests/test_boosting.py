"""Second-order boosting against a row-by-row version; stopping, continued training, storage."""

import math
import random
import tempfile

import pytest

from basketlab.operators import boosting as B

FEATURES = ["a", "b", "c"]
SCHEMA = "id long, a double, b double, c double, reordered int"


def data(seed, n=400):
    rng = random.Random(seed)
    rows = [(i, round(rng.random(), 2), float(rng.randrange(4)), rng.choice([None, 0.5, -1.0, 2.0])) for i in range(n)]
    return [(*r, int((r[1] > .5) ^ (r[2] > 2)) if rng.random() < .85 else rng.randrange(2)) for r in rows]


@pytest.fixture(scope="module")
def frames(spark):
    rows = data(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return rows, df, df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")


def brute(rows, cuts, p, rounds):
    """Trees as nested tuples, grown one split at a time from sums over rows."""
    x = [[sum(c <= (v or 0.0) for c in own) for own, v in zip(cuts, r[1:4])] for r in rows]
    y, margin, trees = [r[4] for r in rows], [0.0] * len(rows), []

    def quality(g, h):
        g = math.copysign(max(abs(g) - p.alpha, 0), g)
        return g * g / (h + p.lambda_)

    def value(g, h):
        return -math.copysign(max(abs(g) - p.alpha, 0), g) / (h + p.lambda_) * p.eta

    for _ in range(rounds):
        q = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(q, y)], [a * (1 - a) for a in q]
        sums = lambda own: (sum(g[i] for i in own), sum(h[i] for i in own))

        def best(own, depth):
            if p.max_depth and depth >= p.max_depth:
                return None
            found = None
            for f in range(len(cuts)):
                for b in range(1, len(cuts[f]) + 1):
                    left, right = [i for i in own if x[i][f] < b], [i for i in own if x[i][f] >= b]
                    if min(len(left), len(right)) < max(1, p.min_child_rows) or min(sums(left)[1], sums(right)[1]) < p.min_child_weight:
                        continue
                    gain = quality(*sums(left)) + quality(*sums(right)) - quality(*sums(own))
                    if gain > 1e-6 and gain >= p.gamma and (found is None or gain > found[0] + 1e-9):
                        found = (gain, f, b, left, right)
            return found

        leaves = [{"rows": list(range(len(rows))), "depth": 0}]
        leaves[0]["best"] = best(leaves[0]["rows"], 0)
        splits = []
        while True:
            ready = [k for k in leaves if k["best"]]
            if not ready or p.max_leaves and len(leaves) >= p.max_leaves:
                break
            k = min(ready, key=lambda k: (k["depth"] if p.growth == "level" else 0, -k["best"][0]))
            gain, f, b, left, right = k["best"]
            splits.append((f, b, gain, len(left), len(right)))
            leaves.remove(k)
            for own in (left, right):
                leaves.append({"rows": own, "depth": k["depth"] + 1, "best": best(own, k["depth"] + 1)})
        for k in leaves:
            for i in k["rows"]:
                margin[i] += value(*sums(k["rows"]))
        trees.append((sorted(splits), sorted((len(k["rows"]), value(*sums(k["rows"]))) for k in leaves)))
    return trees, margin


def shape(tree):
    rows = lambda k: tree[k].rows
    return (sorted((n.feature, n.bin, n.gain, rows(n.left), rows(n.right)) for n in tree if n.feature >= 0),
            sorted((n.rows, n.value) for n in tree if n.feature < 0))


@pytest.mark.parametrize("kw", [dict(max_depth=3), dict(max_depth=2, lambda_=11, alpha=3, gamma=0.5, min_child_weight=4),
                                dict(growth="leaf", max_depth=0, max_leaves=6, lambda_=0.0, min_child_rows=15),
                                dict(growth="leaf", max_depth=3, max_leaves=7, alpha=1), dict(max_depth=3, max_leaves=5, cuts="width")])
def test_trees_equal_row_by_row_growth(frames, kw):
    rows, df, *_ = frames
    p = B.Params(rounds=3, max_bins=8, patience=None, checkpoint_rounds=2, **kw)
    m = B.fit_boosted(df, FEATURES, p)
    want, margin = brute(rows, m.cuts, p, 3)
    for t, (splits, leaves) in zip(m.trees, want, strict=True):
        own = shape(t)
        assert [list(s) for s in own[0]] == [pytest.approx(s, abs=1e-3) for s in map(list, splits)]
        assert [list(x) for x in own[1]] == [pytest.approx(x, abs=1e-5) for x in map(list, leaves)]
    got = {r.id: (r.margin, r.score) for r in B.predict(m, df, ["id"]).collect()}
    for r, v in zip(rows, margin):
        assert got[r[0]][0] == pytest.approx(v, abs=1e-5) and got[r[0]][1] == pytest.approx(1 / (1 + math.exp(-v)), abs=1e-5)
    assert len(m.losses) == 3
    loss = -sum(math.log(1 / (1 + math.exp(-v if r[4] else v))) for r, v in zip(rows, margin)) / len(rows)
    assert m.losses[-1] == pytest.approx(loss, abs=1e-5)


def test_same_model_from_any_partitioning(frames, monkeypatch):
    p = B.Params(rounds=4, max_depth=3, subsample=0.6, colsample_bytree=0.7, colsample_bylevel=0.7, trees_per_round=2, patience=None)
    a, b = (B.fit_boosted(frames[1].repartition(n), FEATURES, p) for n in (1, 5))
    assert a.trees == b.trees and a.losses == b.losses and len(a.trees) == 8
    assert any(t[0].rows < 300 for t in a.trees)  # each tree has a sample of the rows
    monkeypatch.setattr(B, "DIRECT", 0)  # cells added up by an aggregate
    c = B.fit_boosted(frames[1], FEATURES, p)
    assert a.trees == c.trees and a.losses == c.losses


def test_stops_while_training(frames):
    _, _, train, test = frames
    p = B.Params(rounds=200, max_depth=3, eta=0.9, lambda_=0.0, patience=4)
    m = B.fit_boosted(train, FEATURES, p, evaluation=test)
    assert len(m.trees) == len(m.losses) == m.best + 4 < 200 and len(m.used) == m.best
    assert m.losses[m.best - 1] == min(m.losses)
    alone = B.fit_boosted(train, FEATURES, B.Params(rounds=6, max_depth=2, patience=3))  # the training rows stand in
    assert alone.best == 6 and alone.losses == sorted(alone.losses, reverse=True)


def test_training_continues_from_a_model(frames):
    _, df, *_ = frames
    folds = [df.filter(f"id % 3 = {k}") for k in range(3)]
    p = B.Params(rounds=5, max_depth=2, patience=None)
    models = B.fit_continued(folds, FEATURES, p)
    assert [len(m.trees) for m in models] == [5, 10, 15]
    assert models[2].trees[:10] == models[1].trees and models[1].trees[:5] == models[0].trees
    # the first margins of the second fold are the first model's scores: one more tree from them is the sixth
    score = {r.id: r.score for r in B.predict(models[0], folds[1], ["id"]).collect()}
    g = sum(score[r.id] - r.reordered for r in folds[1].collect())
    h = sum(s * (1 - s) for s in score.values())
    root = models[1].trees[5][0]
    assert root.cover == pytest.approx(h, abs=1e-4) and root.value == pytest.approx(-g / (h + 1) * 0.3, abs=1e-5)
    with pytest.raises(ValueError):
        B.fit_boosted(folds[0], FEATURES, B.Params(rounds=1, trees_per_round=2), start=models[0])


def test_saved_model_scores_alike(spark, frames):
    m = B.fit_boosted(frames[2], FEATURES, B.Params(rounds=20, max_depth=3, patience=2), evaluation=frames[3])
    d = tempfile.mkdtemp(prefix="boosted-")
    B.save(spark, m, d)
    back = B.load(spark, d)
    a, b = (sorted(map(tuple, B.predict(x, frames[3], ["id"]).collect())) for x in (m, back))
    assert a == b and len(back.trees) == m.best
    imp = {r.feature: r for r in B.importance(spark, m).collect()}
    splits = [n for t in m.used for n in t if n.feature >= 0]
    assert sum(r.weight for r in imp.values()) == len(splits)
    assert sum(r.total_gain for r in imp.values()) == pytest.approx(sum(n.gain for n in splits))
    assert B.loss_history(spark, m).count() == len(m.losses)


def test_defined_cases(spark):
    none = B.fit_boosted(spark.createDataFrame([], SCHEMA), FEATURES, B.Params(rounds=2))
    df = spark.createDataFrame([(1, None, float("nan"), 1.0, 1), (2, 0.0, 0.0, 1.0, None)], SCHEMA)
    assert {r.score for r in B.predict(none, df).collect()} == {0.5}
    one = B.fit_boosted(df, FEATURES, B.Params(rounds=1, patience=None))  # one labelled row: a leaf
    assert [len(t) for t in one.trees] == [1] and one.trees[0][0].rows == 1
    for bad in (dict(growth="other"), dict(max_bins=1), dict(max_depth=0), dict(growth="leaf", max_depth=0)):
        with pytest.raises(ValueError):
            B.Params(**bad)


def test_kept_margins_and_exact_sums_of_a_full_block(spark, monkeypatch):
    import numpy as np
    from pyspark.core.rdd import RDD
    n = B.BLOCK  # all rows in one cell, each with the largest hessian: the sums still are exact
    block = {"id": np.arange(n).astype("<u8"), "y": np.ones(n, "<f4"), "evaluated": np.ones(n, bool), "trained": np.ones(n, bool),
             "bins": np.zeros((1, n), "u1"), "margin": np.zeros(n)}
    found, loss = B.histograms(spark.sparkContext.parallelize([block] * 3, 2), [], [[B.Node()]], [(0, 0)], [0], B.Params(), [0], 2, True, 2)
    assert found[0, 0][0].tolist() == [[-n * 1.5, n * .75, 3 * n], [0, 0, 0]] and loss == (pytest.approx(3 * n * math.log(2), rel=1e-6), 3 * n)

    df = spark.createDataFrame(data(4), SCHEMA)
    rows_walked, steps = [], []
    histograms, checkpoint = B.histograms, RDD.checkpoint
    monkeypatch.setattr(B, "histograms", lambda table, pending, *a: rows_walked.append(sum(map(len, pending))) or histograms(table, pending, *a))
    monkeypatch.setattr(RDD, "checkpoint", lambda self: steps.append(1) or checkpoint(self))
    p = B.Params(rounds=9, max_depth=3, max_bins=8, patience=None, checkpoint_rounds=2)
    models = [B.fit_boosted(df, FEATURES, p)]
    assert max(rows_walked) < B.PENDING and len(steps) >= 1  # a job walks few nodes, however many trees there are
    monkeypatch.setattr(B, "PENDING", 1 << 30)
    models.append(B.fit_boosted(df, FEATURES, p))
    for a, b in zip(models[0].trees, models[1].trees, strict=True):
        assert [(x.feature, x.bin, x.rows) for x in a] == [(x.feature, x.bin, x.rows) for x in b]
    assert models[0].losses == pytest.approx(models[1].losses, abs=1e-6)


def test_bundled_features_have_the_sums_of_single_ones(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(3)
    key, n = rng.integers(0, 40, 700), 700
    bins = np.stack([key % 7, key // 3, rng.integers(0, 250, n), key, rng.integers(0, 250, n)]).astype("u1")
    plain = [{"id": rng.integers(0, 1 << 60, n).astype("<u8"), "y": rng.integers(0, 2, n).astype("<f4"), "evaluated": rng.random(n) < .3,
              "trained": rng.random(n) < .9, "bins": np.ascontiguousarray(bins[:, ::step]), "margin": rng.normal(size=n)} for step in (1, -1, 1)]
    monkeypatch.setattr(B, "GROUP", 2)
    monkeypatch.setattr(B, "BLOCK", 512)
    coded = list(B.bundled(plain))
    assert sum(len(b["y"]) for b in coded) == 3 * n and [b["first"] for b in coded] == [True, False, False, True, False]
    assert all([f for f, _ in b["bundles"]] == [[0, 1, 3]] and b["single"] == [2, 4] and len(b["bins"]) == 2 for b in coded)
    tree = [B.Node(2, 100, 0.0, 1, 2), B.Node(3, 20, 0.0, 3, 4), B.Node(), B.Node(value=.5), B.Node(value=-.5)]
    for features in ([0, 1, 2, 3, 4], [0, 4], [1, 3]):
        for share in (1.0, 0.5):
            a, b = (B.histograms(spark.sparkContext.parallelize(own, k), [tree], [tree], [(0, 2), (0, 4)], features, B.Params(subsample=share), [5], 256, True, k)
                    for own, k in ((plain, 2), (coded, 1)))
            assert all((a[0][w] == b[0][w]).all() for w in a[0]) and a[1] == b[1]
    assert sum(len(b["id"]) for b in coded) == 3 * n and not any("id" in b for b in B.bundled(plain, False))
    monkeypatch.setattr(B, "MASKED", 0)  # row by row
    assert (B.leaf_of(tree, B.Coded(coded[0])) == B.leaf_of(tree, B.Coded(coded[0]).whole())).all()


def test_a_job_of_few_blocks_starts_one_task_for_each_core(spark):
    df = spark.createDataFrame(data(5), SCHEMA).repartition(40)
    table = B.blocks(B.binned(df, FEATURES, "reordered", [[.5], [1.0], [.5]], 0.0, True, True))
    assert table.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_gradient_boosting_has_the_scores_of_spark_ml(spark):
    from pyspark.ml.classification import GBTClassifier
    from basketlab.operators import ml as ML
    rng = random.Random(11)
    own = [(i, float(rng.randrange(9)), float(rng.randrange(5)), rng.choice([-1.0, 0.5, 2.0])) for i in range(900)]
    own = [(*r, int((r[1] > 4) ^ (r[2] > 2) ^ (r[3] > 1)) if rng.random() < .8 else rng.randrange(2)) for r in own]
    df = spark.createDataFrame(own, SCHEMA).withColumnsRenamed({"id": "user_id"})
    preset = ML.PRESETS["gbt"](6)
    assert isinstance(preset.estimator(), GBTClassifier)
    a, b = (ML.score(f(df, preset, FEATURES), df, FEATURES).orderBy("user_id").collect() for f in (ML.fit, ML.fit_scaled))
    assert [r.score for r in b] == pytest.approx([r.score for r in a], abs=1e-6) and len({round(r.score, 6) for r in a}) > 20
    # values between those of the training rows fall on the same side, also on the middle
    between = spark.createDataFrame([(i, rng.randrange(36) / 4, rng.randrange(20) / 4, rng.choice([None, -.25, 0.0, 1.25, 9.0]), 1) for i in range(300)],
                                    SCHEMA).withColumnsRenamed({"id": "user_id"})
    a, b = (ML.score(f(df, preset, FEATURES), between, FEATURES).orderBy("user_id").collect() for f in (ML.fit, ML.fit_scaled))
    assert [r.score for r in b] == pytest.approx([r.score for r in a], abs=1e-6)
    m = ML.fit_scaled(df, preset, FEATURES)
    assert isinstance(m, B.Ensemble) and len(m.used) == 6
    with pytest.raises(ValueError):
        ML.gradient_params(ML.Preset("gbt", {**preset.params, "subsamplingRate": 0.5}))


def test_cuts_halfway_to_the_value_below(spark):
    xs = [float(i * i) for i in range(100)]
    df = spark.createDataFrame([(x, float(i % 4), 1.0) for i, x in enumerate(xs)], "a double, b double, c double").repartition(3)
    a, b, c = B.cut_points(df, ["a", "b", "c"], B.Params(max_bins=8, cuts="middle"))
    assert c == [] and [round(v, 9) for v in b] == [0.5, 1.5, 2.5]
    quantiles = B.cut_points(df, ["a"], B.Params(max_bins=8))[0]
    assert a == [math.nextafter((v + xs[xs.index(v) - 1]) / 2, math.inf) for v in quantiles]
