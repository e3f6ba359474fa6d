import hashlib
import random

import pytest
from pyspark.sql import functions as F

from basketlab.llm import sketch as S


def shingles(t):
    w = [x for x in t.split() if x]
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def text(rng, n):
    return " ".join(rng.choice("ab cd ef gh ij kl mn op é ñ".split()) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = [(i * 37 - 900, text(rng, rng.choice([0, 1, 3, 8, 60, 400]))) for i in range(200)]
    rows += [(10 ** 15, text(rng, 50)), (-10 ** 15, "  \n "), (2 ** 62, None), (10 ** 6, rows[7][1])]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, sketch int")


def test_fingerprints_against_brute_force(corpus):
    rows, df = corpus
    got = {r.doc_id: r for r in S.fingerprints(df).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for j, (i, t) in enumerate(order):
        t, nxt = t or "", order[(j + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = shingles(t), shingles(edited), shingles(nxt)
        for near, x in ((r.near_edited, b), (r.near_next, c)):
            exact = len(a & x) / len(a | x) if a | x else 1.0
            assert near == pytest.approx(exact, abs=1e-12 if len(a | x) <= S.K else 0.2)
        assert len(r.sketch) == min(S.K, len(a)) and r.sketch == sorted(set(r.sketch))
    assert got[10 ** 6].sketch == got[rows[7][0]].sketch


def test_ties_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b c"), (None, "x y"), (2, "a")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_chars, r.near_next) for r in S.fingerprints(df).collect())
    assert got == [("1", 1, 0.0), ("1", 3, 0.0), ("2", 1, 1.0), ("None", 3, 0.0)]
    assert S.fingerprints(df.limit(0)).count() == 0
    assert S.fingerprints(df.filter("doc_id = 2")).first().near_next == 1.0  # its own successor


def test_estimates(spark):
    rng = random.Random(9)
    a = text(rng, 3000)
    b = " ".join(a.split()[:1500] + text(rng, 1500).split())
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        S.bottom_k(F.col("a")).alias("x"), S.bottom_k(F.col("b")).alias("y"), "a", "b")
    r = df.select(S.resemblance(F.col("x"), F.col("y")).alias("near"), S.containment(F.col("x"), F.col("y")).alias("within"),
                  S.distinct_shingles(F.col("x")).alias("n"),
                  S.merged(F.col("x"), F.col("y")).alias("both")).first()
    x, y = shingles(a), shingles(b)
    assert r.near == pytest.approx(len(x & y) / len(x | y), abs=0.15)
    assert r.within == pytest.approx(len(x & y) / len(x), abs=0.25)
    assert r.n == pytest.approx(len(x), rel=0.35)
    parts = df.select(F.lit(1).alias("g"), F.explode(F.array("x", "y")).alias("sketch"))
    assert S.merge_sketches(parts, ["g"]).first().sketch == r.both


def test_native(corpus):
    plan = S.fingerprints(corpus[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
