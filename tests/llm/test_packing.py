import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketlab.llm.packing import best_fit_packing, fullest, minimum_bin_slack, packed_sequences, word_encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", "   ", "Hello, World!", "don't we'll", "ÉCOLE naïve straße", "a\x1cb c d e", "é Éx", "日本語 テスト 😀", "12 3a",
         "<|endoftext|> x", "hello <|endoftext|> world", "a<|endoftext|>b <|startoftext|>c!", "< |endoftext|>", "ΑΣ ΟΔΟΣ", "x" * 500, "!!! ... ##$ (a)", "İstanbul", "\x00 a\x00b", "word " * 9000, None, "Hello, World!"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def test_word_encoder_is_the_tokenizer(tok):
    encode = word_encoder(PATH, max_words=50)  # small, so that it is emptied on the way
    rng = random.Random(3)
    some = [" ".join(rng.choice(["The", "of,", "été", "ß.", "Ñu", "a-b", "x!", "naïve"]) + rng.choice(["", "s", "é"]) for _ in range(40))
            for _ in range(40)]
    for t in [x for x in TEXTS if x is not None] + some:
        assert np.frombuffer(encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_fullest_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        have = Counter(rng.randint(1, 12) for _ in range(rng.randint(0, 9)))
        room = rng.randint(0, 30)
        items = list(have.elements())
        best = max(sum(c) for n in range(len(items) + 1) for c in itertools.combinations(items, n) if sum(c) <= room)
        used = fullest(room, have)
        assert sum(k * v for k, v in used.items()) == best and all(v <= have[k] for k, v in used.items())


def test_patterns_use_up_the_histogram():
    rng = random.Random(2)
    have = Counter(min(100, int(rng.expovariate(0.05)) + 1) for _ in range(5000))
    used, bins = Counter(), 0
    for times, items in minimum_bin_slack(have, 100):
        assert sum(k * n for k, n in items) <= 100
        bins += times
        for k, n in items:
            used[k] += n * times
    assert used == have and bins <= -(-sum(k * v for k, v in have.items()) // 100) * 1.01 + 1


def test_packing(spark, tok):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(None, "null id", "z"), (3, "repeated id", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = best_fit_packing(df, PATH).collect()
    want = []
    for i, t, _ in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(seqs) == -(-sum(w[3] for w in want) // 4096)


def test_sequences_and_empty(spark, tok):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    packed = best_fit_packing(df, PATH)
    total = sum(len(r.ids) for r in packed_sequences(df, packed, PATH).collect())
    assert total == packed.selectExpr("sum(length) AS n").first().n
    assert best_fit_packing(df.limit(0), PATH).count() == 0
