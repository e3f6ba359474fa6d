import random

import numpy as np
import pytest

from basketlab.llm import suffix_dedup as D


def brute(rows, match):
    """(id, bytes, removed, spans, kept) by looking up every string."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - match + 1):
            if b[p:p + match] in seen:
                gone[p:p + match] = True
            seen.add(b[p:p + match])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def found(df, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in D.remove_repeats(df, **kw).collect()), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)]
    line = " ".join(word() for _ in range(20))
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        if rng.random() < 0.5:
            parts.insert(rng.randint(0, 3), line)
        rows.append((i * 7 % n, "\n".join(parts)))
    rows += [(1000, "a" * 700), (1001, "ab" * 300), (1002, "a" * 99), (1003, "a" * 100), (1004, None), (1005, ""), (1006, rows[3][1]),
             (1007, rows[3][1])]
    return rows


@pytest.mark.parametrize("seed,match,gram", [(1, 100, 40), (2, 30, 8), (3, 30, 29)])
def test_against_brute_force(spark, monkeypatch, seed, match, gram):
    monkeypatch.setattr(D, "BATCH_BYTES", 4000)  # many batches and levels
    monkeypatch.setattr(D, "SLICE_BYTES", 1000)
    monkeypatch.setattr(D, "HOT", 2)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, kept string").repartition(3)
    assert found(df, match=match, gram=gram) == brute(rows, match)


def test_repeated_and_null_ids(spark):
    rows = corpus(4, 10)
    rows += [(3, "z " * 100), (3, "z " * 100), (None, rows[0][1]), (None, "q" * 250)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows, 100)
    assert D.remove_repeats(df.limit(0)).count() == 0


def test_parameters(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for kw in ({"match": 10, "gram": 10}, {"gram": 0}, {"match": 2000, "gram": 5}):
        with pytest.raises(ValueError):
            D.remove_repeats(df, **kw)


def test_family_levels_merge_geometrically():
    rng = np.random.default_rng(0)
    family, seen = D.Family(), set()
    for n in range(1, 33):
        k0, k1 = rng.integers(0, 300, 40), rng.integers(0, 3, 40)
        a, stands, _ = D.suffix_array(k0, k1, np.arange(40), np.zeros(40, np.int64))
        a = [c[stands] for c in a]
        old = family.known(a[0], a[1])
        assert old.tolist() == [(x, y) in seen for x, y in zip(a[0].tolist(), a[1].tolist())]
        family.add([c[~old] for c in a])
        seen |= set(zip(a[0].tolist(), a[1].tolist()))
        assert sum(r for r, _ in family.levels) == n and len(family.levels) == bin(n).count("1")


def test_text_and_carried_columns(spark):
    rng = random.Random(6)
    passage = "".join(rng.choice("éèàüñ") for _ in range(59)) + "é"
    rows = [(1, "x" + passage, "a"), (2, "é" * 5 + "y" + passage[:-1] + "è tail", "b"), (3, None, "c"), (3, "short", "d"), (None, "z", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    for part in (df, df.filter("doc_id <= 2")):
        got = {r.row.spans: r for r in D.remove_repeats(part, carry=["doc_id", "spans"], as_text=True).collect()}
        assert got["b"].kept == "é" * 5 + "y tail"  # the rest of the "è" that was cut is gone
        assert got["a"].kept == "x" + passage and got["a"].row.doc_id == got["a"].doc_id == 1
    assert len(D.remove_repeats(df, carry=["doc_id", "spans"]).collect()) == 5


@pytest.mark.parametrize("grams", [1, 3, 200])
def test_levels_find_what_was_added(grams):
    rng = np.random.default_rng(grams)
    family, seen = D.Family(), set()
    for _ in range(9):
        k0, k1 = rng.integers(-grams, grams, 300), rng.integers(-400, 400, 300)
        order = np.lexsort((k1, k0))
        k0, k1 = k0[order], k1[order]
        assert family.known(k0, k1).tolist() == [x in seen for x in zip(k0.tolist(), k1.tolist())]
        family.add([k0, k1, k0, k1])
        seen |= set(zip(k0.tolist(), k1.tolist()))
    assert len(family.all()[0]) == 9 * 300
