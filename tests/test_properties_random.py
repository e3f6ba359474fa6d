"""Randomised equivalence checks of the rewrites against brute force."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from basketlab.operators import base as B
from basketlab.operators import metrics as MT
from basketlab.operators import product as P
from basketlab.operators import streaks as S
from conftest import rows
from test_streaks_cooc_metrics import brute_streaks

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

order_sets = st.lists(st.sets(st.integers(1, 40), min_size=1, max_size=15), min_size=1, max_size=3)


@SETTINGS
@given(order_sets, st.sampled_from([0, 2, 5, 1024]))
def test_streaks_are_the_runs(spark, sets, whole_rows):
    data = [(u, 3, 1000 * u + n, n) for u, s in enumerate(sets) for n in s]
    df = spark.createDataFrame(data, "user_id long, product_id long, order_id long, order_number int")
    cols = ("user_id", "product_id", "grp", "length_of_streaks")
    for mode in ("compat", "island"):
        a = rows(S.streak_lengths(df, mode, whole_rows), *cols)
        assert a == sorted((*k, v) for k, v in brute_streaks(data, mode).items())
        assert sum(r[3] for r in a) == len(data)
    # island lengths are the true consecutive runs
    for u, s in enumerate(sets):
        runs, prev = [], None
        for n in sorted(s):
            if prev is not None and n == prev + 1:
                runs[-1] += 1
            else:
                runs.append(1)
            prev = n
        got = sorted(r.length_of_streaks for r in S.streak_lengths(df, "island", whole_rows)
                     .filter(F.col("user_id") == u).collect())
        assert got == sorted(runs)


baskets = st.lists(st.lists(st.one_of(st.none(), st.integers(1, 6)), min_size=1, max_size=6),
                   min_size=1, max_size=6)


@SETTINGS
@given(baskets)
def test_cooccurrence_identity_equals_selfjoin(spark, orders):
    lines_rows = [(o, p, i + 1, 0) for o, basket in enumerate(orders) for i, p in enumerate(basket)]
    lines = spark.createDataFrame(lines_rows, "order_id long, product_id long, add_to_cart_order int, reordered int")
    ords = spark.createDataFrame([(o, 1, o + 1, 0, 8) for o in range(len(orders))],
                                 "order_id long, user_id long, order_number int, order_dow int, order_hour_of_day int")
    op = B.order_product_stats(lines, ords)
    a = lines.select("product_id", "order_id").alias("a")
    b = lines.select(F.col("product_id").alias("p2"), F.col("order_id").alias("o2"))
    brute = (a.join(b, (F.col("a.order_id") == F.col("o2")) & (F.col("a.product_id") != F.col("p2")), "left")
             .groupBy("a.product_id", "a.order_id").agg(F.count("p2").alias("n")))
    per_pair = brute.groupBy("product_id").agg(F.sum("n").alias("s"), F.min("n").alias("lo"),
                                               F.max("n").alias("hi"))
    assert rows(per_pair, "product_id", "s") == rows(P.product_cooccurrence(op), "product_id",
                                                      "number_of_product_co_occurred")
    got = rows(P.product_cooc_per_order(op), "product_id", "min_of_co_ocuured_product_per_order",
               "max_of_co_ocuured_product_per_order")
    assert got == rows(per_pair, "product_id", "lo", "hi")


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=30))
def test_auc_equals_pairwise(spark, pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame([(y, s / 6.0) for y, s in pairs], "label int, score double")
    assert abs(MT.roc_auc(df).first().auc - round(want, 6)) < 1e-9
