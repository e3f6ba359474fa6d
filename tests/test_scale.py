"""Tasks stay small as the tables grow: shuffle partitions follow the rows, Gram sums read blocks."""

import math
import random

import pytest

from basketlab import session
from basketlab.operators import glm as G
from basketlab.plans.features import FeatureSet
from basketlab.schemas import ORDER_PRODUCTS, ORDERS

KEY = "spark.sql.shuffle.partitions"


def test_shuffle_partitions_follow_the_order_lines(spark, monkeypatch):
    before = spark.conf.get(KEY)
    lines = spark.createDataFrame([(o, p, p + 1, int(o > 3)) for o in range(60) for p in range(5)], ORDER_PRODUCTS)
    orders = spark.createDataFrame([(o, o % 3, "prior", o // 3 + 1, o % 7, o % 24, 1) for o in range(60)], ORDERS).drop("eval_set")
    products = spark.createDataFrame([(p, f"p{p}") for p in range(5)], "product_id long, product_name string")
    try:
        assert session.enough_partitions(spark, 1) == int(before) == int(spark.conf.get(KEY))  # never lowered
        want = sorted(map(tuple, FeatureSet(lines, orders, products).streak_lengths("island").collect()))
        monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
        got = sorted(map(tuple, FeatureSet(lines, orders, products).streak_lengths("island").collect()))
        assert int(spark.conf.get(KEY)) == 30 and got == want
    finally:
        spark.conf.set(KEY, before)


def test_gram_sums_read_blocks(spark):
    from pyspark.sql import functions as F
    rng = random.Random(5)
    own = [(rng.random(), float(rng.randrange(5)), int(rng.random() < .4)) for _ in range(G.BLOCK + 7)]
    df = spark.createDataFrame(own, "a double, b double, reordered int").coalesce(1)
    table = G.blocks(df.select(F.col("reordered").cast("double").alias("y"), F.array("a", "b").alias("x")))
    assert table.count() <= len(own) / 1000 + 2
    import numpy as np
    mean, sd, weights = np.array([.5, 2.0]), np.array([.3, 1.5]), np.array([-.2, .4, .1])
    g, deviance, n = G.gram(table, mean, sd, weights)
    total, lost = [[0.0] * 4 for _ in range(4)], 0.0
    for a, b, y in own:
        z = [1, (a - .5) / .3, (b - 2) / 1.5]
        eta = sum(u * v for u, v in zip(z, weights))
        p = 1 / (1 + math.exp(-eta))
        full = [*z, eta + (y - p) / (p * (1 - p))]
        for i in range(4):
            for j in range(4):
                total[i][j] += full[i] * full[j] * p * (1 - p)
        lost -= 2 * math.log(p if y else 1 - p)
    assert n == len(own) and deviance == pytest.approx(lost) and g.tolist() == [pytest.approx(t, abs=1e-6) for t in total]


def test_streak_state_is_not_merged_into_few_tasks(spark):
    from basketlab.operators import streaks as S
    before = spark.conf.get(KEY)
    op = spark.createDataFrame([(u, p, 10 * u + k, k) for u in range(40) for p in range(2) for k in (1, 2, 4)],
                               "user_id long, product_id long, order_id long, order_number int")
    try:
        spark.conf.set(KEY, "6")
        assert S.order_number_state(op).rdd.getNumPartitions() == 6
        for mode, want in (("island", {(1, 80), (2, 80)}), ("compat", {(1, 80), (2, 80)})):
            lengths = S.streak_lengths(op, mode)
            parts = lengths.rdd.getNumPartitions()
            assert parts == 6  # those of the state: the lengths need no further shuffle
            assert {tuple(r) for r in lengths.groupBy("length_of_streaks").count().collect()} == want
    finally:
        spark.conf.set(KEY, before)


def test_gram_blocks_are_read_one_at_a_time_and_exact(spark):
    import pickle

    import numpy as np
    from pyspark.sql import functions as F
    rng = random.Random(7)
    own = [(rng.random(), float(rng.randrange(900)), rng.choice([0.0, -0.0, 1e300]), i % 2) for i in range(2 * G.BLOCK + 9)]
    df = spark.createDataFrame(own, "a double, b double, c double, reordered int").coalesce(1)
    table = G.blocks(df.select(F.col("reordered").cast("double").alias("y"), F.array("a", "b", "c").alias("x")))
    found = [pickle.loads(b) for b in table.collect()]  # a record is one block: a task holds no batch of them
    assert sum(len(y) for y, _ in found) == len(own) and max(len(y) for y, _ in found) <= G.BLOCK
    assert [number.dtype.name if number is not None else None for _, number in found[0][1]] == [None, "uint16", "uint8"]
    back = [np.concatenate([v if k is None else v.take(k) for v, k in (columns[j] for _, columns in found)]) for j in range(3)]
    assert [b.tobytes() for b in back] == [np.array([r[j] for r in own]).tobytes() for j in range(3)]
    table.unpersist()


def test_order_statistics_read_the_bits_of_doubles(spark):
    from basketlab.functions import quantiles as Q
    rng = random.Random(9)
    xs = [rng.choice([0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 2.0 ** -1022, rng.gauss(0, 1), rng.uniform(-1e9, 1e9)]) for _ in range(300)]
    df = spark.createDataFrame([(x, None if i % 3 else -x) for i, x in enumerate(xs)] + [(float("nan"), 1.0), (None, float("nan"))], "x double, y double")
    ys = [-x for i, x in enumerate(xs) if i % 3 == 0] + [1.0]
    got = Q.order_statistics(df, {"x": range(0, 300, 7), "y": range(0, len(ys), 5)})
    assert got == {"x": {r: sorted(xs)[r] for r in range(0, 300, 7)}, "y": {r: sorted(ys)[r] for r in range(0, len(ys), 5)}}
    plan = Q.counted(df, [(0, 0)], 0)._jdf.queryExecution().executedPlan().toString()
    assert "POWER" not in plan.upper() and "LOG2" not in plan.upper()  # no exponent is worked out by logarithms
