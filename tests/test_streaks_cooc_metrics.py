"""FIXTURES §4 (streak lengths), §5 (co-occurrence) and §6 (metrics)."""

import pytest
from pyspark.sql import functions as F

from basketlab.operators import base as B
from basketlab.operators import metrics as MT
from basketlab.operators import product as P
from basketlab.operators import streaks as S
from conftest import rows

SEQS = [
    ([1, 2, 3, 4], [1, 3], [4]),
    ([1, 2, 4], [1, 2], [1, 2]),
    ([1, 3, 4], [1, 2], [1, 2]),
    ([1, 3, 5], [3], [1, 1, 1]),
    ([2, 3, 5, 6, 7, 10], [1, 2, 3], [1, 2, 3]),
]


@pytest.mark.parametrize("seq,compat,island", SEQS)
def test_streak_lengths(spark, seq, compat, island):
    df = spark.createDataFrame([(1, 7, 100 + n, n) for n in seq],
                               "user_id long, product_id long, order_id long, order_number int")
    for mode, want in (("compat", compat), ("island", island)):
        got = sorted(r.length_of_streaks for r in S.streak_lengths(df, mode).collect())
        assert got == want, mode
    # both modes cover every purchase exactly once
    assert S.streak_lengths(df, "island").agg(F.sum("length_of_streaks")).first()[0] == len(seq)


def test_streak_mode_validated(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], "user_id long, product_id long, order_id long, order_number int")
    with pytest.raises(ValueError):
        S.streak_lengths(df, "bogus")


COOC_LINES = [(1, 10), (1, 11), (1, 11), (2, 10), (3, 11), (3, 12), (3, 13), (4, None)]


def _cooc_op(spark):
    lines = spark.createDataFrame([(o, p, 1, 0) for o, p in COOC_LINES],
                                  "order_id long, product_id long, add_to_cart_order int, reordered int")
    orders = spark.createDataFrame([(o, 1, o, 0, 8) for o in range(1, 5)],
                                   "order_id long, user_id long, order_number int, order_dow int, "
                                   "order_hour_of_day int")
    return lines, B.order_product_stats(lines, orders)


def test_cooccurrence_identity(spark):
    _, op = _cooc_op(spark)
    got = rows(P.product_cooccurrence(op).filter(F.col("product_id").isNotNull()),
               "product_id", "number_of_product_co_occurred")
    assert got == [(10, 2), (11, 4), (12, 2), (13, 2)]
    per = rows(op.filter(F.col("product_id").isNotNull()), "product_id", "order_id", "co")
    assert per == [(10, 1, 2), (10, 2, 0), (11, 1, 2), (11, 3, 2), (12, 3, 2), (13, 3, 2)]


def test_cooccurrence_equals_bruteforce_selfjoin(spark):
    """Brute force on the small fixture only: the reference's self-join."""
    lines, op = _cooc_op(spark)
    a = lines.select("product_id", "order_id").alias("a")
    b = lines.select(F.col("product_id").alias("p2"), F.col("order_id").alias("o2")).alias("b")
    brute = (a.join(b, (F.col("a.order_id") == F.col("o2")) & (F.col("a.product_id") != F.col("p2")), "left")
             .groupBy("a.product_id").agg(F.count("p2").alias("n")))
    assert rows(brute, "product_id", "n") == rows(P.product_cooccurrence(op), "product_id",
                                                   "number_of_product_co_occurred")


def test_metrics_fixture(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.6), (1, 0.4), (0, 0.1)], "label int, score double")
    assert rows(MT.confusion_counts(scored), "confusion_cell", "n") == [("fn", 1), ("fp", 1), ("tn", 1), ("tp", 1)]
    m = MT.all_metrics(scored).first()
    assert (m.precision, m.recall, m.f1) == (0.5, 0.5, 0.5)
    assert m.auc == pytest.approx(0.75)
    assert m.logloss == pytest.approx(0.510826, abs=1e-6)


def test_auc_with_ties_matches_pairwise_count(spark):
    data = [(1, 0.5), (0, 0.5), (1, 0.7), (0, 0.2), (1, 0.2), (0, 0.9), (1, 0.9)]
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    got = MT.roc_auc(spark.createDataFrame(data, "label int, score double")).first().auc
    assert got == pytest.approx(want, abs=1e-6)


def brute_streaks(data, mode):
    """Rows (user, product, order, number) -> {(user, product, grp): length}, row by row."""
    groups, out = {}, {}
    for u, p, o, n in data:
        groups.setdefault((u, p), []).append((n is not None, n or 0, o, n))
    for key, own in groups.items():
        own.sort()
        flags = [int(a[3] is not None and b[3] is not None and b[3] - a[3] == 1) for a, b in zip(own, own[1:])] + [0]
        for i, (_, _, _, n) in enumerate(own):
            if mode == "compat":
                grp = sum(f != flags[i] for f in flags[:i])
            else:
                grp = None if n is None else n - i - 1
            out[(*key, grp)] = out.get((*key, grp), 0) + (n is not None)
    return out


EDGE_ROWS = [(1, 7, 10, 1), (1, 7, 11, 2), (None, 7, 90, None), (None, 7, 91, None), (1, None, 12, 3), (1, None, 13, 4),
             (2, 8, 20, 5), (2, 8, 21, 5), (2, 8, 22, 6), (2, 8, 23, None), (2, 8, 24, 9), (None, 8, 92, 3), (None, 8, 93, 4),
             (3, 9, None, 1), (3, 9, 30, 2)]


WIDE = [(50, 1, n, n) for n in range(40, 300) if n % 7] + [(51, 1, n, n * 64 - 1) for n in range(1, 6)] + [(51, 1, 100 + n, n * 64) for n in range(1, 6, 2)] \
    + [(52, 2, n, 127 + n // 3) for n in range(12)] + [(53, 2, n, -n) for n in range(5)] + [(52, 2, 99, None), (None, None, 98, 64), (None, None, 97, 63)] \
    + [(54, 3, n, 2_000_000_000 + n) for n in range(3)]


@pytest.mark.parametrize("bucket_rows,whole_rows", [(1, 0), (2, 2), (3, 5), (4096, 1024)])
def test_streaks_against_brute_force(spark, bucket_rows, whole_rows):
    """Tiny buckets force runs across bucket boundaries, small arrays the unfolding as rows; orphan lines, NULL keys and equal numbers stay."""
    data = EDGE_ROWS + WIDE + [(10 + i, 7, 1000 * i + n, n) for i, (seq, _, _) in enumerate(SEQS) for n in seq]
    df = spark.createDataFrame(data, "user_id long, product_id long, order_id long, order_number int")
    for mode in ("compat", "island"):
        got = {(r.user_id, r.product_id, r.grp): r.length_of_streaks for r in S.streak_lengths(df, mode, whole_rows).collect()}
        assert got == brute_streaks(data, mode), mode
    flags = S.streak_flags(df, bucket_rows)
    assert flags.count() == len(data)
    want = []
    for u, p, o, n in data:
        own = sorted(((x[3] is not None, x[3] or 0, x[2] or 0, x[3]) for x in data if x[:2] == (u, p)))
        i = own.index((n is not None, n or 0, o or 0, n))
        nxt = own[i + 1][3] if i + 1 < len(own) else None
        want.append((u, p, o, n, nxt, int(n is not None and nxt is not None and nxt - n == 1)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in flags.collect())


def test_orphan_lines_reach_the_product_statistics(spark):
    df = spark.createDataFrame(EDGE_ROWS[:5], "user_id long, product_id long, order_id long, order_number int")
    for whole_rows in (0, 4096):
        r = S.product_streak_stats(S.streak_lengths(df, "compat", whole_rows)).filter("product_id = 7").first()
        assert (r.Total_streak_of_this_product, r.min_of_streaks_of_this_product) == (3, 0)
        assert r.mean_of_streaks_of_this_product == pytest.approx(2 / 3)


def executed_plan(df, spark):
    """The plan as it ran, without broadcasts."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df.collect()
        q = df._jdf.queryExecution()
        q.executedPlan().execute().count()
        return q.executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("mode", S.STREAK_MODES)
def test_lengths_take_two_exchanges_and_no_join(spark, mode):
    import re
    df = spark.createDataFrame(EDGE_ROWS + WIDE, "user_id long, product_id long, order_id long, order_number int")
    p = executed_plan(S.streak_lengths(df, mode), spark)
    assert len(re.findall(r"\+- Exchange hashpartitioning", p)) <= 2 and "Join" not in p


def test_flags_window_within_buckets(spark):
    """The rows are exchanged once; what follows a bucket comes from the few pairs with several buckets."""
    import re
    df = spark.createDataFrame(EDGE_ROWS, "user_id long, product_id long, order_id long, order_number int")
    p = executed_plan(S.streak_flags(df), spark)
    assert all("windowspecdefinition(bucket" in x for x in p.splitlines() if re.search(r"Window \[", x))
    assert len([x for x in p.splitlines() if "Exchange hashpartitioning(bucket" in x]) <= 3
