import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from basketlab.llm.periodic import Extensions, periodic_runs, runs_of, with_periodic_tails
from basketlab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(w, min_length=24, min_periods=3):
    """(start, length, period) by a walk over the words for each period."""
    found = {}
    for q in range(1, len(w) // min_periods + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(min_length, min_periods * q):
                found.setdefault((start, i + q - start), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, words):
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def edited(doc_id, text):
    w = SPACE.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_extensions_against_comparison(seed):
    rng = np.random.default_rng(seed)
    sizes = [200, 90, 31, 1]
    words = np.concatenate([np.append(np.tile(rng.integers(0, 2, 1 + seed * 5), 300)[:n] if seed else rng.integers(0, 3, n), 10 + k)
                            for k, n in enumerate(sizes)])
    text = np.repeat(np.arange(4), np.array(sizes) + 1)
    i = rng.integers(0, 200, 3000)
    j = rng.integers(0, 200, 3000)
    i, j = i[i != j], j[i != j]
    got = Extensions(words, text).common(i, j)
    for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
        k = 0
        while max(a, b) + k < len(words) and words[a + k] == words[b + k]:
            k += 1
        assert n == k


@pytest.mark.parametrize("seed", range(3))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, k = rng.choice([0, 1, 23, 24, 70, 160]), rng.choice([1, 2, 3, 6])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < .7:
                a, p = rng.randrange(n), rng.randint(1, 20)
                w = [x if i < a + p else w[a + (i - a) % p] for i, x in enumerate(w)]
            texts.append(w)
        texts.sort(key=len, reverse=True)
        least, periods = rng.choice([(24, 3), (2, 2), (6, 3)])
        flat = np.array([x for t in texts for x in t], np.int64)
        of, *rest = runs_of(flat, np.array([len(t) for t in texts]), least, periods)
        got = list(zip(of.tolist(), *(x.tolist() for x in rest)))
        assert got == [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t, least, periods)]


def test_query_against_brute_force(spark):
    got = QUERIES["op11_periodic_runs"](spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: brute_row(r.doc_id, edited(r.doc_id, r.text)) for r in rows}
    assert sum(r.n_runs > 0 for r in got) > 5
    for r in got:
        assert tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                    "collapsed_sha256")) == want[r.doc_id]
    assert len(got) == len(rows)


def test_defined_cases(spark):
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 23), (4, "a\n" * 24), (None, "x y " * 30), (6, "a " * 24 + "b " * 24),
             (7, "ab " * 40_000), (8, "a\x1cb a\x1cb " * 20), (9, "one two three " * 8 + "one")]
    df = spark.createDataFrame([(i, t, "k", [1]) for i, t in texts], "doc_id long, text string, collapsed string, runs array<int>")
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed)
                  for r in periodic_runs(df).collect()), key=lambda r: (r[0], r[1]))
    assert got == [
        (0, 60, [(0, 60, 2)], (0, 60, 2), "x y"), (1, 0, [], None, ""), (2, 0, [], None, ""), (3, 0, [], None, ""),
        (4, 23, [], None, " ".join("a" * 23)), (4, 24, [(0, 24, 1)], (0, 24, 1), "a"),
        (6, 48, [(0, 24, 1), (24, 24, 1)], (0, 24, 1), "a b"), (7, 40_000, [(0, 40_000, 1)], (0, 40_000, 1), "ab"),
        (8, 40, [(0, 40, 1)], (0, 40, 1), "a\x1cb"), (9, 25, [(0, 25, 3)], (0, 25, 3), "one two three")]
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(df, min_periods=1)


def test_periodic_tails(spark):
    rows = [(i, f"w{i}  " + "\n".join(str(k % 50) for k in range(i % 70))) for i in range(200)] + [(10**9 + 7, ""), (2**40, None), (None, "a b")]
    got = {r.doc_id: r.text for r in with_periodic_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 10 or not t:
            assert got[i] == t
        else:
            assert got[i] == " ".join(edited(i, t))
