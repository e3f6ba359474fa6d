import random

import public_tokenizers
import pytest
import tiktoken

from basketlab.llm.bpe import LONG, TextCodec, WordCodec, decode_ids, encode_decode, load_ranks, merge_table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", " ", "\n", "  a  b \n c\t d", "a \n\n b", "x" * 300 + "==" * 200 + " don't we'll 123 45é ñ  z ", "a\n b", " a", "a b ",
         "\x1f a \x1c b", "日本語 テスト 😀 😀‍ x  ", "\x00\x00 nul", "a  b  c", "\r\n\r\n a", "ab" * 3000]


@pytest.fixture(scope="module")
def own():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("block", [3, 500_000])
def test_codec_against_tiktoken(own, block):
    ranks = load_ranks(PATH)
    codec = TextCodec(ranks, merge_table(ranks), public_tokenizers.PATTERN, max_words=200, block=block)
    rng = random.Random(5)
    alphabet = "ab cé \n\tß'sd 12日.,!  "
    for texts in [TEXTS, *(["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(60)] for _ in range(5))]:
        ids = codec.encode(texts)
        assert ids == [",".join(map(str, own.encode_ordinary(t))) for t in texts]
        assert codec.codec.decode(ids, rows=7) == codec.codec.decode(ids) == [t.encode() for t in texts]


@pytest.mark.parametrize("text", ["random letters", "a" * ((1 << 20) + 5), "=-" * (1 << 19) + "=", " " * ((1 << 20) + 5), "ab" * 50_000,
                                  " " + "é日" * 20_000])
def test_long_words(own, text):
    if text == "random letters":
        text = "".join(random.Random(3).choices("etaoinshrdlu", k=(1 << 20) + 3))
    ranks = load_ranks(PATH)
    codec = TextCodec(ranks, merge_table(ranks), public_tokenizers.PATTERN)
    assert codec.split.findall(text) == [text]
    [ids] = codec.encode([text])
    assert ids == ",".join(map(str, own._core_bpe.encode_single_piece(text.encode())))
    assert codec.codec.decode([ids]) == [text.encode()]


def test_long_white_space_before_a_word():
    ranks = load_ranks(PATH)
    codec = TextCodec(ranks, merge_table(ranks), public_tokenizers.PATTERN)
    text = "a" + " \n" * 300_000 + "  b"
    assert codec.codec.decode(codec.encode([text, "x"])) == [text.encode(), b"x"]


def contracted(word, ranks):
    """Ids of a word, a pair at a time."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while pairs := [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]:
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_any_ranks_and_both_ways():
    rng = random.Random(8)  # ranks in no order of length, so that a contraction may make a pair of a lower rank
    tokens = {bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(120)}
    ranks = {bytes([i]): i + 1000 for i in range(256)} | {t: r for r, t in enumerate(rng.sample(sorted(tokens), len(tokens)))}
    codec = WordCodec(ranks, merge_table(ranks))
    words = sorted({bytes(rng.choices(b"abcd", k=n)) for n in [*range(1, LONG + 40), 500, 900] for _ in range(4)})
    want = [contracted(w, ranks) for w in words]
    assert [codec.contracted(w) for w in words] == [contracted(w, ranks) for w in words]
    whole = [([ranks[w]] if w in ranks else x) for w, x in zip(words, want)]  # a word that is a token is not taken apart
    assert codec.encode(words) == [",".join(map(str, x)) for x in whole]


def test_many_words_of_some_length(own):
    words = [bytes(random.Random(i).choices(b"etaoin", k=n)) for i in range(150) for n in (LONG - 1, LONG, LONG + 1, 3000)]
    ranks = load_ranks(PATH)
    assert WordCodec(ranks, merge_table(ranks)).encode(words, step=20_000) == [",".join(map(str, own._core_bpe.encode_single_piece(w))) for w in words]


def test_rows(spark, own):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "null id", 0), (3, None, 0), (3, "twice", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = encode_decode(df, PATH, public_tokenizers.PATTERN).collect()
    want = [(i, own.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    assert sorted(((r.doc_id, r.n_tokens, r.ids, bytes(r.decoded)) for r in got), key=str) == sorted(
        ((i, len(x), ",".join(map(str, x)), b) for i, x, b in want), key=str)
    coded = spark.createDataFrame([(r.doc_id, r.ids) for r in got], "doc_id long, ids string")
    back = decode_ids(coded, PATH).collect()
    assert sorted((bytes(r.decoded) for r in back)) == sorted(b for _, _, b in want)
    assert encode_decode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
