"""Exact selection, special functions, type inference, skewed joins and the elastic-net path against plain versions."""

import math
import os
import random
import struct
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlab.functions import skew as SK
from basketlab.functions.quantiles import _sortable, exact_quantiles, order_statistics
from basketlab.functions.special import chi_square_tail, log_gamma, upper_gamma
from basketlab.operators import eda as E
from basketlab.operators import glm as G
from basketlab.sources.infer import infer_types, read_inferred


# ---------------------------------------------------------------- quantiles
def doubles(seed=1):
    rng = random.Random(seed)
    special = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 0.1, 2.0 ** 53 + 1]
    return (special + [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(500)]
            + [2.0 ** k for k in range(-1074, 1024, 3)] + [math.nextafter(2.0 ** k, 0) for k in range(-1073, 1024, 5)])


def test_bits_order_like_the_doubles(spark):
    df = spark.createDataFrame([(x,) for x in doubles()], "x double").select("x", _sortable(F.when(F.col("x") == 0, 0.0).otherwise(F.col("x"))).alias("b"))
    for r in df.collect():
        own = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.b == (-own if r.x < 0 else own)


def test_order_statistics(spark):
    rng = random.Random(3)
    a, b = doubles(2), [float(rng.randrange(5)) for _ in range(400)]
    n = max(len(a), len(b))
    rows = [(a[i] if i < len(a) else None, b[i] if i < len(b) else float("nan")) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(3)
    ranks = {"a": [0, 7, len(a) // 2, len(a) - 1], "b": [0, 100, 399]}
    got = order_statistics(df, ranks)
    assert got == {"a": {r: sorted(a)[r] for r in ranks["a"]}, "b": {r: sorted(b)[r] for r in ranks["b"]}}
    assert exact_quantiles(df, "b", [0, 0.3, 0.5, 1]) == [float(np.quantile(b, p)) for p in (0, 0.3, 0.5, 1)]
    assert exact_quantiles(df.filter("b > 9"), "b", [0.5]) is None
    with pytest.raises(ValueError):
        order_statistics(df, {"b": [400]})


def test_box_stats_by_refined_counts(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(round(rng.gauss(0, 3), 4),) for _ in range(501)] + [(99.5,), (None,)], "x double")
    assert E.box_stats(df, "x", bounded=False).first() == E.box_stats(df, "x").first()
    assert E.box_stats(df.filter("x > 1000"), "x", bounded=False).first().n == 0


# ---------------------------------------------------------------- special functions
def test_gamma_functions(spark):
    rows = [(a, x) for a in (0.5, 1.0, 1.5, 5.0, 69.0, 200.5, 5000.0) for x in (0.0, 0.1, 1.0, 4.0, 60.0, 69.0, 80.0, 300.0, 5000.0, 5100.0)]
    d = spark.createDataFrame(rows, "a double, x double").coalesce(1)
    for r in d.select("a", "x", log_gamma(F.col("a")).alias("lg"), upper_gamma(F.col("a"), F.col("x")).alias("q")).collect():
        assert r.lg == pytest.approx(math.lgamma(r.a), rel=1e-12, abs=1e-12)
        half = 0.0 if r.a == int(r.a) else 0.5
        want = (math.erfc(math.sqrt(r.x)) if half else 0.0) + sum(
            math.exp(-r.x + (i + half) * math.log(r.x) - math.lgamma(i + half + 1)) for i in range(int(r.a - half))) if r.x else 1.0
        assert r.q == pytest.approx(want, abs=1e-10)


def test_chi_square_p_value(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.randrange(3), rng.randrange(4)) for _ in range(300)], "r int, c int")
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    v = VectorAssembler(inputCols=["c"], outputCol="f").transform(df.withColumn("y", F.col("r").cast("double")))
    want = ChiSquareTest.test(v, "f", "y").first()
    got = E.chi_square_test(df, "r", "c").first()
    assert (got.statistic, got.dof) == (pytest.approx(want.statistics[0], abs=1e-6), 6) and got.p_value == pytest.approx(want.pValues[0], abs=1e-6)
    assert spark.range(1).select(chi_square_tail(F.lit(3.0), F.lit(0)).alias("p")).first().p == 1.0


# ---------------------------------------------------------------- inference
CSV = """id,big,share,day,at,flag,mixed,empty,text,late
1,3000000000,0.5,2024-02-29,2024-01-01 10:00:00,true,1,,a,7
-2,5,1e3,2023-01-31,2024-01-01T10:00,FALSE,x,,2024-13-45,8
+3,,7,,2024-01-02,,true,,"b, c",9.5
"""


def test_types_from_all_rows(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="infer-"), "f.csv")
    with open(path, "w") as f:
        f.write(CSV)
    r = {x.column_name: x for x in infer_types(spark, path).collect()}
    assert {c: x.inferred for c, x in r.items()} == {
        "id": "int", "big": "long", "share": "double", "day": "date", "at": "timestamp", "flag": "boolean", "mixed": "string",
        "empty": "string", "text": "string", "late": "double"}
    assert (r["big"].n_long, r["big"].n_int, r["big"].nulls, r["day"].nulls, r["empty"].nulls) == (1, 1, 1, 1, 3)
    assert (r["at"].n_timestamp, r["at"].n_date, r["mixed"].conflicts, r["late"].conflicts, r["text"].conflicts) == (2, 1, 2, 0, 0)
    assert all(x.rows == 3 == x.nulls + sum(x[f"n_{c}"] for c in ("boolean", "int", "long", "double", "date", "timestamp", "string")) for x in r.values())
    df = read_inferred(spark, path)
    assert [t for _, t in df.dtypes] == ["int", "bigint", "double", "date", "timestamp_ntz", "boolean", "string", "string", "string", "double"]
    assert df.agg(F.sum("id"), F.sum("big"), F.sum("late"), F.count_if("flag")).first() == (2, 3000000005, 24.5, 1)


def test_a_late_row_decides(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="infer-"), "f.csv")
    with open(path, "w") as f:
        f.write("n,only\n" + "".join(f"{i},{i}\n" for i in range(5000)) + "oops,\n")
    r = {x.column_name: x for x in infer_types(spark, path).collect()}
    assert (r["n"].inferred, r["n"].conflicts, r["only"].inferred) == ("string", 1, "int")


# ---------------------------------------------------------------- joins
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_skew_join_equals_the_plain_join(spark, how):
    rng = random.Random(6)
    key = lambda: rng.choice([1] * 30 + [2] * 20 + [None] * 5 + list(range(3, 60)))
    left = spark.createDataFrame([(key(), rng.choice(["x", None]), i) for i in range(400)], "k int, j string, a int")
    right = spark.createDataFrame([(rng.choice([2] * 9 + [None] * 4 + list(range(40, 90)) + [1]), rng.choice(["x", "y", None]), i) for i in range(120)],
                                  "k int, j string, b int")
    for on in (["k"], ["k", "j"]):
        own = left.select(*on, "a"), right.select(*on, "b")
        got = SK.skew_join(*own, on, how, support=0.05, salts=4)
        want = own[0].join(own[1], on, how).select(*on, "a", "b")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        SK.skew_join(left, right, ["k"], "cross")


def test_a_third_of_the_rows_is_dealt(spark):
    """A key with a third of the right side's rows of a left join: no task of the executed join has them all."""
    left = spark.range(300).select((F.col("id") % 100).alias("k"), F.col("id").alias("a"))
    right = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("b")).repartition(6)
    assert SK.heavy_hitters(right, ["k"], 0.2) and len(SK.heavy_hitters(right, ["k"], 0.2)) <= 6
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = left.join(right, "k", "left")
        own = SK.skew_join(left, right, ["k"], "left", support=0.2)
        size = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert own.count() == plain.count()
        most, before = size(own), size(plain)
        assert "_salt" in own._jdf.queryExecution().executedPlan().toString() and most < 0.6 * before
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


# ---------------------------------------------------------------- elastic net
def proximal(x, y, l1, l2, rounds=60_000):
    """Plain proximal gradient on the standardised features, intercept first."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / sd])
    b = np.zeros(z.shape[1])
    step = 4 / np.linalg.eigvalsh(z.T @ z / len(x)).max()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z @ b))
        g = z.T @ (p - y) / len(x)
        g[1:] += l2 * b[1:]
        new = b - step * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * l1, 0)
        if np.abs(new - b).max() < 1e-13:
            break
        b = new
    own = b[1:] / sd
    return b[0] - own @ mean, own


def test_path_equals_a_plain_solver(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 4)) * [1, 5, 0.2, 1] + [0, 3, 0, -1]
    x[:, 3] = x[:, 0] * 0.8 + x[:, 3] * 0.3
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 0] - 0.3 * x[:, 1] + 1)))).astype(int)
    rows = [(*map(float, r), 5.0, int(v)) for r, v in zip(x, y)] + [(1.0, 1.0, 1.0, 1.0, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, same double, reordered int").repartition(3)
    names = ["a", "b", "c", "d", "same"]
    path = G.fit_path(df, names, alpha=0.7, steps=4, least=0.01)
    assert [p.penalty for p in path.points] == sorted((p.penalty for p in path.points), reverse=True)
    assert all(b == 0 for b in path.points[0].coefficients) and path.points[0].deviance == pytest.approx(path.null_deviance)
    for p in path.points[1:]:
        b0, b = proximal(x, y, p.penalty * 0.7, p.penalty * 0.3)
        assert p.intercept == pytest.approx(b0, abs=1e-5) and p.coefficients == pytest.approx([*b, 0.0], abs=1e-5)
    assert any(v == 0 for v in path.points[1].coefficients[:4])
    h = G.history(spark, path).orderBy("step").collect()
    assert [r.explained for r in h] == sorted(r.explained for r in h) and h[0].nonzero == 0
    last = path.points[-1]
    got = G.predict(path, df.limit(3), ["a", "b", "c", "d"]).collect()
    for r in got:
        eta = last.intercept + sum(b * v for b, v in zip(last.coefficients, r[:4]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-eta)))
    assert G.coefficients(spark, path).count() == 4 * 6
    ridge = G.fit_path(df, names, alpha=0.0, penalties=[0.1])
    b0, b = proximal(x, y, 0.0, 0.1)
    assert ridge.points[0].coefficients == pytest.approx([*b, 0.0], abs=1e-5)
    with pytest.raises(ValueError):
        G.fit_path(df.filter("reordered = 1"), names)
