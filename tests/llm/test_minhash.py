import random

import numpy as np
import pytest

from basketlab.llm.minhash import block_keys, components, differing, likeness, near_duplicates, prob_minhash, weighted_shingles
from basketlab.llm.suffix_dedup import Hasher


def counts(t, n=5):
    w = t.split()
    out = {}
    for i in range(max(1, len(w) - n + 1) if w else 0):
        s = " ".join(w[i:i + n])
        out[s] = out.get(s, 0) + 1
    return out


def brute(a, b):
    a, b = counts(a), counts(b)
    if not a or not b:
        return float(len(a) == len(b))
    every = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in every) for d in set(a) & set(b))


def words(rng, n):
    return [rng.choice("ab cd ef gh ij kl mn op qr st é ñ".split()) + rng.choice("xyz") for _ in range(n)]


def edited(rng, w, k):
    w = list(w)
    for _ in range(k):
        w[rng.randrange(len(w))] = "new" + str(rng.randrange(10 ** 6))
    return w


def test_shingles_and_likeness():
    rng = random.Random(1)
    texts = ["", "a", "a b\tc \n d", " a  b c d e ", "x y z " * 30, "é ñ ß 日 本 語"]
    base = words(rng, 80)
    texts += [" ".join(base), " ".join(edited(rng, base, 3)), " ".join(base * 2), " ".join(base[:40] * 3)]
    text, shingle, weight = weighted_shingles(texts, Hasher(5))
    sets = []
    for i, t in enumerate(texts):
        own = text == i
        sets.append((shingle[own], weight[own]))
        assert sorted(weight[own]) == sorted(counts(t).values())
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert likeness(*sets[i], *sets[j]) == pytest.approx(brute(a, b), abs=1e-9)


def test_registers_agree_as_often_as_the_likeness():
    rng = random.Random(2)
    base = words(rng, 200)
    a, b = " ".join(base + base[:60]), " ".join(edited(rng, base, 8) + base[:20])
    text, shingle, weight = weighted_shingles([a, b, "one"], Hasher(5))
    won = prob_minhash(text, shingle, weight, 3, 4096)
    assert (won[0] == won[1]).mean() == pytest.approx(brute(a, b), abs=0.04)
    assert (won != 0).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 4), (3, 4)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in (1, 2, 3, 4, 5)} == {1} and got[11] == 10 and {got[i] for i in range(100, 141)} == {100}


def classes(rows):
    """Class of each row: union of equal texts and of pairs of texts with a likeness of 0.8 or more; named by the smallest id."""
    texts = sorted({t or "" for _, t in rows})
    parent = {t: t for t in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, t in enumerate(texts):
        for u in texts[:n]:
            if t.split() and u.split() and brute(t, u) >= 0.8:
                parent[find(t)] = find(u)
    ids = {}
    for i, t in rows:
        ids.setdefault(find(t or ""), []).append(i)
    return [min((i for i in ids[find(t or "")] if i is not None), default=None) for _, t in rows]


def test_against_all_pairs(spark):
    rng = random.Random(7)
    rows = []
    for g in range(12):
        base = words(rng, rng.choice([30, 80, 200]))
        for _ in range(rng.choice([1, 2, 6])):
            w = edited(rng, base, rng.choice([0, 1, 2, 5, 20]))
            rows.append((len(rows) * 3 % 101 + 1000 * len(rows), " ".join(w)))
    chain = words(rng, 200)
    for _ in range(5):  # linked in a row, the ends far apart
        rows.append((50 + len(rows), " ".join(chain)))
        chain = chain[8:] + words(rng, 8)
    rows += [(1, ""), (2, None), (3, "  \n"), (4, "a b"), (6, "a b"), (7, "a b c"), (None, "a b"), (None, "nobody else has this"), (8, "repeat me twice"), (8, "repeat me twice"),
             (8, "another text of eight"), (9, "another text of eight")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, class_id string")
    got = near_duplicates(df).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.kept) for r in got) == sorted(
        (str(i), str(c), i == c) for (i, _), c in zip(rows, classes(rows)))
    assert near_duplicates(df.limit(0)).count() == 0


def test_large_group_is_one_class(spark):
    rng = random.Random(8)
    base = words(rng, 150)
    rows = [(i, " ".join(edited(rng, base, 2))) for i in range(300)] + [(1000 + i, " ".join(words(rng, 60))) for i in range(20)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = dict(zip([i for i, _ in rows], classes(rows)))
    assert {r.doc_id: r.class_id for r in got} == want and set(want.values()) == {0, *range(1000, 1020)}


def test_no_text_is_lost_when_ids_repeat(spark):
    """Each distinct text keeps a row, whatever ids its rows have."""
    rows = [(5, "first text of a few words here"), (5, "quite another text with its own words"), (3, "first text of a few words here"),
            (9, "quite another text with its own words"), (None, "quite another text with its own words"), (5, "a third text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.class_id, r.kept) for r in got) == sorted(
        [("5", 3, False), ("5", 5, True), ("3", 3, True), ("9", 5, False), ("None", 5, False), ("5", 5, True)])
    import hashlib
    kept = {r.text_sha256 for r in got if r.kept}
    assert kept == {hashlib.sha256(t.encode()).hexdigest() for _, t in rows}


def test_blocks_are_bounded_and_any_two_ids_meet(spark):
    members = [(k, i * 7 + k, 300) for k in (1, 2) for i in range(300)] + [(3, i, 50) for i in range(50)]
    ids = sorted({i for _, i, _ in members})
    found = spark.createDataFrame([(i, 0) for i in range(50)], "id long, component long")
    sizes = spark.createDataFrame([(i, 10) for i in ids], "id long, size long")
    still = spark.createDataFrame(members, "key long, id long, n long")
    for limits in ((40, 1 << 20), (10_000, 400)):  # by members, by bytes
        rows = block_keys(still, found, sizes, *limits).collect()
        tasks = {}
        for r in rows:
            tasks.setdefault((r.key, r.i, r.j), ([], []))[0 if r.left else 1].append(r.id)
        assert max(len(a) + len(b) for a, b in tasks.values()) < 100  # 300 members of a bucket
        met = [(k, min(a, b), max(a, b)) for (k, i, j), (x, y) in tasks.items()
               for a in x for b in (y if i < j else [z for z in x if z > a])]
        assert len(met) == len(set(met))
        merged = set(range(50))
        want = {(k, a, b) for k in (1, 2) for a in range(k, 2100, 7) for b in range(a + 7, 2100, 7) if {a, b} - merged}
        assert want <= set(met) and not any(k == 3 for k, _, _ in met)  # bucket 3 is one component
    assert {r.id: r.keys for r in rows if r.id in (8, 400)} == {8: [1, 3], 400: [1]}


@pytest.mark.parametrize("limits", [{}, {"block_rows": 6}, {"block_bytes": 4000}])
def test_large_buckets_of_many_components(spark, limits):
    rng = random.Random(12)
    base = words(rng, 120)
    rows = [(i, " ".join(edited(rng, base, rng.choice([3, 5, 6, 8])))) for i in range(60)]
    rows += [(100 + i, " ".join(edited(rng, t.split(), 1))) for i, t in rows[::6]]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **limits).collect()
    want = dict(zip([i for i, _ in rows], classes(rows)))
    assert {r.doc_id: r.class_id for r in got} == want and len(set(want.values())) > 20


def test_differing_counts_unequal_fields():
    import numpy as np
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 16, (4, 30)), rng.integers(0, 16, (4, 30))
    b[0] = a[0]
    pack = lambda x: (x.reshape(4, 2, 15).astype(np.uint64) << (np.uint64(4) * np.arange(15, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)
    for k in range(4):
        assert differing(pack(a)[k], pack(b)).tolist() == (a[k] != b).sum(axis=1).tolist()
