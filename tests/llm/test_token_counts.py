import random

import public_tokenizers
from tokenizers import Tokenizer, models

from basketlab.llm.token_counts import SPACE, Trie, count_tokens, load_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, pieces, unseen):
    """Best segmentation by plain dynamic programming over one word; the longer last piece on ties."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        found = (best[end - 1][0] + n * unseen, best[end - 1][1] + n)
        for start in range(end - 1, -1, -1):
            s = pieces.get(word[start:end])
            if s is not None and best[start][0] + s >= found[0]:
                found = (best[start][0] + s, best[start][1] + 1)
        best.append(found)
    return best[-1][1]


def test_trie_against_brute_force_and_library():
    pieces = load_pieces(PATH)
    trie = Trie(pieces)
    rng = random.Random(4)
    words = sorted({SPACE + "".join(rng.choice(["th", "ing", "é", "x", "on", "日", "ß", "a", "!", "\U0001F600"]) for _ in range(rng.randint(1, 9)))
                    for _ in range(500)})
    trie.insert(words[::2])
    trie.insert([w for w in words[1::2] if w not in trie.counts])
    assert trie.nodes < sum(map(len, words))  # prefixes are shared
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items()], unk_id=0, byte_fallback=False))
    for w in words:
        assert trie.counts[w] == brute(w, pieces, trie.unseen), w
        e = library.encode(w)
        if 0 not in e.ids:
            assert len(e.ids) == trie.counts[w], w


def test_prefixes_are_scored_once():
    trie = Trie({"a": -1.0, "ab": -1.5, "b": -1.0})
    trie.insert(["abab"])
    trie.score[2] = -0.25  # as found for the prefix "ab": later insertions must build on it
    trie.insert(["abb", "ab"])
    assert trie.nodes == 5 and trie.score[5] == -1.25 and trie.counts == {"abab": 2, "abb": 2, "ab": 1}
    for w in ("abab", "abb", "ab"):
        at = 0
        for c in w:
            at = trie.child[at << 21 | ord(c)]
        assert trie.tokens[at] == trie.counts[w]


def test_small_vocabulary_and_clearing():
    trie = Trie({"a": -1.0, "ab": -1.5, "b": -1.0, "abc": -9.0}, max_nodes=2)
    trie.insert(["abc", "ab", "é"][::-1])
    assert trie.counts == {"ab": 1, "é": 2, "abc": 1}
    trie.insert(["b"])
    assert trie.counts == {"b": 1}


def test_rows(spark):
    pieces = load_pieces(PATH)
    unseen = Trie(pieces).unseen
    rows = [(1, "the thing then the"), (2, None), (3, " \n "), (3, "été"), (None, "x" * 2000 + " y"), (5, "日本 \x1c z")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, n_tokens string")
    got = sorted(((r.doc_id, r.n_tokens, r.n_pretokens) for r in count_tokens(df, PATH).collect()), key=str)
    want = [(i, sum(brute(SPACE + w, pieces, unseen) for w in (t or "").split()), len((t or "").split())) for i, t in rows]
    assert got == sorted(want, key=str)
    assert count_tokens(df.limit(0), PATH).count() == 0
