import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from basketlab.llm.phrases import TOTAL, collocations, frequent_phrases
from basketlab.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, lang string, text string, rank string, n int"


def phrases_of(rows, longest=3):
    counts, total = defaultdict(Counter), Counter()
    for _, lang, text, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    return counts, total


def brute(rows, support, longest=3, contained=50, top=2000):
    counts, total = phrases_of(rows, longest)
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if a >= support and " " in p}
        best = []
        for p, a in cand.items():
            w = p.split(" ")
            cuts = [(" ".join(w[:k]), " ".join(w[k:])) for k in range(1, len(w))]
            score, _, x, y = min((1_000_000 * a * a // (f[x] * f[y]), k, x, y) for k, (x, y) in enumerate(cuts))
            if not any(f" {p} " in f" {q} " and q != p and 100 * b >= contained * a for q, b in cand.items()):
                best.append((-score, -a, p.encode(), f[x], f[y]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(best)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def corpus(seed, docs=150):
    rng = random.Random(seed)
    words = ["A", "b", "c d", "e", "f\tg", "É", "x-y", "\x1c", "zz", "q"] + [f"w{i}" for i in range(30)]
    weights = [8, 8, 4, 3, 2, 2, 2, 1, 1, 1] + [.3] * 30
    out = []
    for i in range(docs):
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]) for w in rng.choices(words, weights, k=rng.randint(0, 60)))
        out.append((i, rng.choice(["en", "en", "de", None]), text, "k", 1))
    return out + [(5, "en", None, "k", 1), (None, None, "a b e a b e", "k", 1), (7, "", "", "k", 1), (8, "xx", "A b A b " * 3000, "k", 1)] \
        + [(9, "en", "same words again here", "k", 1)] * 12


@pytest.mark.parametrize("sample", [0.0, 0.1, 0.6, 1.0])
def test_every_sample_gives_the_exact_counts(spark, sample):
    rows = corpus(1)
    passes = []
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = frequent_phrases(df, support=6, sample=sample, proposing=2, passes=passes).collect()
    counts, total = phrases_of(rows)
    want = {(g, p): n for g, f in counts.items() for p, n in f.items() if n >= 6} | {(g, TOTAL): n for g, n in total.items()}
    assert {(r.lang, r.phrase): r.n for r in found} == want and len(found) == len(want)
    assert len(passes) == (3 if sample == 0 else len(passes)) and passes[-1] == 0  # words, their pairs, their triples


@pytest.mark.parametrize("seed,support,longest,contained,top", [(2, 6, 3, 50, 2000), (3, 3, 2, 50, 7), (4, 2, 3, 90, 40)])
def test_against_brute_force(spark, seed, support, longest, contained, top):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(collocations(df, support, longest, contained, top)) == brute(rows, support, longest, contained, top)


def test_shuffled_lookup_and_small_memory(spark, monkeypatch):
    import basketlab.llm.phrases as P
    monkeypatch.setattr(P, "sized_for_broadcast", lambda df: df)
    counted = P.counted
    monkeypatch.setattr(P, "counted", lambda *a, **k: counted(*a, **k, max_held=50, max_words=20))
    rows = corpus(5)
    assert got(collocations(spark.createDataFrame(rows, SCHEMA), 4)) == brute(rows, 4)


def test_empty_table_and_wrong_length(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations(spark.createDataFrame([(1, "en", "few words", "k", 1)], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        frequent_phrases(spark.createDataFrame([], SCHEMA), longest=4)


def test_exact_products(spark):
    """Scores of phrases whose products pass 64 bits: the decimals used are exact."""
    a, left, right = 10**12 + 39, 10**15 - 11, 10**13 + 7
    row = spark.sql(f"SELECT (cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)))"
                    f" div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0))) AS s").first()
    assert row.s == 1_000_000 * a * a // (left * right)


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLES["op12_collocations"])
    mine = QUERIES["op12_collocations"](spark, SF)
    assert sorted(want.columns) == sorted(mine.columns)
    assert got(mine) == sorted(map(tuple, want.select("lang, rank, phrase, a, l, r, n, score").fetchall()))
