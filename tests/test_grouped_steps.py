"""Steps that shuffle by one key keep their results where a group is too large for a task, and cost fewer shuffles."""

import pytest
from pyspark.sql import functions as F

from basketlab import session
from basketlab.functions import skew as SK
from basketlab.operators import base as B
from basketlab.schemas import ORDER_PRODUCTS, ORDERS
from basketlab.sources import testdata as TD
from conftest import rows

ORDER_ROWS = [(o, None if o % 11 == 0 else o % 3, "prior", o // 3 + 1, o % 7, o % 24, 1) for o in range(1, 40)]
# order 5 has most of the lines; some lines have no order, no product or an unknown order, some come twice
LINE_ROWS = ([(5, p, p + 1, p % 2) for p in range(60)] + [(o, (o * k) % 9, k, int(k > 1)) for o in range(1, 39) for k in range(1, 4)]
             + [(None, 1, 1, 0), (None, None, 2, None), (7, None, 1, 1), (99, 3, 1, 0), (8, 8, 1, 0), (8, 8, 1, 0)])


@pytest.fixture
def small_groups(monkeypatch):
    monkeypatch.setattr(SK, "GROUP_ROWS", 20)


def test_hot_groups_are_counted(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 30 + [None] * 25 + [2] * 5 + list(range(3, 40))], "k long")
    hot = SK.hot_groups(df, ["k"], 20)
    named = df.select("k", SK.key_hash(["k"]).alias("h")).distinct().filter(F.col("h").isin(hot))
    assert {r.k for r in named.collect()} == {1, None} and SK.hot_groups(df, ["k"], 30) == []
    usual, large = SK.split_by_groups(df, ["k"], hot)
    assert (usual.count(), large.count()) == (42, 55) and SK.split_by_groups(df, ["k"], [])[1] is None


@pytest.mark.parametrize("rows_per_group", [1000, 20])
def test_order_product_stats_by_order(spark, monkeypatch, rows_per_group):
    monkeypatch.setattr(SK, "GROUP_ROWS", rows_per_group)
    lines, orders = spark.createDataFrame(LINE_ROWS, ORDER_PRODUCTS), spark.createDataFrame(ORDER_ROWS, ORDERS)
    want = B.order_product_stats(lines, orders)
    got = B.order_product_stats_by_order(lines, orders)
    assert got.schema.names == want.schema.names and rows(got, *want.columns) == rows(want, *want.columns)


def test_lines_of_an_order_are_shuffled_once(spark):
    lines, orders = spark.createDataFrame(LINE_ROWS, ORDER_PRODUCTS), spark.createDataFrame(ORDER_ROWS, ORDERS)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = B.order_product_stats_by_order(lines, orders)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange") == 2  # the lines and the orders


def test_star_with_hot_users_and_orders(spark, small_groups):
    """Against plain rules in Python: one user has most orders, one order most lines."""
    o = [(k, 1 if k % 5 else k, f"1995-01-{k % 28 + 1:02d}") for k in range(1, 61)] + [(70, None, "1995-01-01")]
    parts = [(p, f"red w{p % 30}") for p in range(1, 61)]
    items = [(3, p, 60 - p) for p in range(1, 61)] + [(k, (k * j) % 60 + 1, j) for k in range(1, 61) for j in range(1, 4)] + [(70, 1, 1)]
    orders = TD.orders_from_tpch(spark.createDataFrame(o, "o_orderkey long, o_custkey long, o_orderdate string"))
    part_map = TD.products_from_part(spark.createDataFrame(parts, "p_partkey long, p_name string"))[3]
    got = TD.order_lines_from_tpch(spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_linenumber int"), part_map, orders)

    number, users = {}, {}
    for k, u, d in sorted(o, key=lambda x: (x[2], x[0])):
        users.setdefault(u, []).append(k)
        number[k] = len(users[u])
    assert sorted((r.order_id, r.order_number, r.eval_set != "prior") for r in orders.collect()) == sorted((k, n, users[u][-1] == k) for (k, u, _) in o for n in [number[k]])
    product = {p: min(q for q, n in parts if n == name) for p, name in parts}
    least = {}
    for k, p, n in items:
        at = (k, product[p])
        least[at] = min(n, least.get(at, n))
    of = {k: u for k, u, _ in o}
    first = {}
    for k, p in least:
        first[of[k], p] = min(number[k], first.get((of[k], p), 99))
    want = []
    for k in of:
        for place, (_, p) in enumerate(sorted((n, p) for (x, p), n in least.items() if x == k), 1):
            if of[k] is not None:
                want.append((k, p, place, int(number[k] > first[of[k], p])))
    assert rows(got, "order_id", "product_id", "add_to_cart_order", "reordered") == sorted(want)


def test_merged_partitions_stay_small(spark):
    key, before, partitions = session.ADVISORY, spark.conf.get(session.ADVISORY), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.enough_partitions(spark, 1)
        assert int(spark.conf.get(key)) == session.MERGED_BYTES
        spark.conf.set(key, "1MB")
        session.enough_partitions(spark, 1)
        assert spark.conf.get(key).lower().startswith("1")  # a smaller setting is kept
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
