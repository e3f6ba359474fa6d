"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad.  The chain scores a line by features of
its own characters and words and by those of the lines before and behind it, and
two neighbouring lines by whether they are of one kind.  Forward and backward
sums give each line's probability to be good, given the whole text; their mean, weighted by
the lines' lengths, is the quality of the document.

The chain is fitted to labelled documents, all lines of a document taking its
label, by L-BFGS on the penalised likelihood of whole chains.  The fit uses a
bounded sample of labelled documents; scores read whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from basketlab.llm.common import id_and_text, text_slices
from basketlab.llm.suffix_dedup import Hasher
from basketlab.llm.toxicity import labelled_rows

# Classes of ASCII characters.
STOPS = b".,;:!?'\"()-"
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
OWN = ("upper", "digits", "symbols", "exclamations", "stops", "words_like_last", "words_seen", "words_ending_in_symbol", "words_in_capitals",
       "single_symbols", "word_length", "long_words", "words", "capital_first", "stop_last", "line_seen", "blank")
NEAR = 11  # leading features that the neighbouring lines lend a line too
SHARPENED = 10  # leading features that also count five times as strongly, up to 1


def feature_names() -> list[str]:
    near = [f"{n}_{side}" for side in ("before", "behind") for n in (*OWN[:NEAR], "none")]
    return ["one", *OWN, *(f"some_{n}" for n in OWN[:SHARPENED]), *near]


# ---------------------------------------------------------------- lines
def byte_classes():
    """Byte to class: 1 upper, 2 lower, 3 digit, 4 stop, 5 symbol, 6 white space, 7 other."""
    import numpy as np
    out = np.full(256, 7, np.uint8)
    out[65:91], out[97:123], out[48:58] = 1, 2, 3
    out[list(STOPS)], out[list(SYMBOLS)] = 4, 5
    out[[9, 10, 11, 12, 13, 32]] = 6
    out[128:192] = 2  # bytes inside characters: letters, but see below
    return out


def line_features(texts: list[str], hasher: Hasher):
    """``doc, weight, x``: of every line the number of its text, its length in bytes, and its features.

    Lines that are blank are left out; a text without any other line has one
    blank line of length 1.
    """
    import numpy as np
    raw = [t.encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    kind = byte_classes()[data]
    after = np.concatenate([[0], data[:-1]])  # capitals of two bytes: C3 80 to C3 9E
    kind[(after == 0xC3) & (data >= 0x80) & (data <= 0x9E)] = 1
    kind[data >= 192] = 0  # first bytes count with the second

    stop = np.flatnonzero(data == 10)
    start = np.concatenate([[0], stop[:-1] + 1])
    space = kind == 6
    full = np.concatenate([[0], np.cumsum(~space)])
    kept = full[stop] > full[start]
    start, stop = start[kept], stop[kept]
    doc = np.searchsorted(ends, start, side="right")
    empty = np.setdiff1d(np.arange(len(texts)), doc)

    def inside(mask):
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[stop] - total[start]).astype(float)

    chars = np.maximum(inside((kind > 0) & ~space), 1)
    letters = np.maximum(inside((kind == 1) | (kind == 2)), 1)
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # words; the last byte is a space
    line = np.searchsorted(stop, begin, side="right")
    hasher.load(data)
    word = hasher.some(begin, end - begin) + (end - begin).astype(np.uint64)
    n_words = np.maximum(np.bincount(line, minlength=len(start)), 1).astype(float)

    def words(mask):
        return np.bincount(line, mask, len(start)) / n_words

    like_last = np.zeros(len(word), bool)
    like_last[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((word, line))
    again = np.zeros(len(word), bool)
    again[order[1:]] = (word[order[1:]] == word[order[:-1]]) & (line[order[1:]] == line[order[:-1]])
    lower = np.concatenate([[0], np.cumsum(kind == 2)])
    upper = np.concatenate([[0], np.cumsum(kind == 1)])
    has = lambda total: total[end] > total[begin]
    length = end - begin
    whole = hasher.some(start, stop - start) + (stop - start).astype(np.uint64)
    order = np.lexsort((np.arange(len(whole)), whole, doc))
    seen = np.zeros(len(whole))
    seen[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    first = np.searchsorted(begin, start)  # each line has a word
    last = np.searchsorted(begin, stop) - 1
    own = [inside(kind == 1) / letters, inside(kind == 3) / chars, inside(kind == 5) / chars, inside(data == 33) / chars,
           inside(kind == 4) / chars, words(like_last), words(again), words(kind[end - 1] == 5), words(has(upper) & ~has(lower)),
           words((length == 1) & (kind[begin] == 5)), np.minimum(words(length) / 10, 3), words(length > 25),
           np.log1p(n_words) / 5, (kind[begin[first]] <= 1) * 1.0, (kind[end[last] - 1] == 4) * 1.0, seen, np.zeros(len(start))]
    own = np.stack(own, axis=1)

    doc = np.concatenate([doc, empty])
    weight = np.concatenate([(stop - start).astype(float), np.ones(len(empty))])
    own = np.concatenate([own, np.eye(len(OWN))[np.full(len(empty), len(OWN) - 1)]])
    order = np.argsort(doc, kind="stable")
    doc, weight, own = doc[order], weight[order], own[order]
    some = np.minimum(own[:, :SHARPENED] * 5, 1)
    near, none = own[:, :NEAR], np.ones((1, NEAR + 1))
    none[0, :NEAR] = 0
    with_flag = np.hstack([near, np.zeros((len(near), 1))])
    before = np.concatenate([none, with_flag[:-1]])
    behind = np.concatenate([with_flag[1:], none])
    new = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    before[new] = none
    behind[np.append(new[1:], True)[:len(doc)]] = none
    return doc, weight, np.hstack([np.ones((len(own), 1)), own, some, before, behind])


# ---------------------------------------------------------------- chain
@dataclass
class Field:
    """A fitted chain: feature weights of a good line, and the weights of two good and two bad neighbours.

    ``share`` stands in for every score where there was nothing to fit.
    """

    weights: object
    good: float = 0.0
    bad: float = 0.0
    share: float | None = None


def chains(doc, n: int):
    """Start, size of the texts' lines, and the texts by falling size."""
    import numpy as np
    size = np.bincount(doc, minlength=n)
    return np.cumsum(size) - size, size, np.argsort(-size, kind="stable")


def forward_backward(score, doc, n: int, good: float, bad: float):
    """``p, good_pairs, bad_pairs, log_z``: of every line the probability to be good, per text
    the expected neighbours that are both good and both bad, and the log of the normaliser.

    ``score`` is the log weight of a good line against a bad one.  Step t handles the t-th
    lines of all texts at once.
    """
    import numpy as np
    start, size, order = chains(doc, n)
    live = [order[:k] for k in np.searchsorted(-size[order], -np.arange(1, size.max(initial=0) + 1), side="right")]
    ahead, behind = np.zeros((len(score), 2)), np.zeros((len(score), 2))
    for t, own in enumerate(live):
        at = start[own] + t
        if t:
            b, g = ahead[at - 1].T
            ahead[at, 0] = np.logaddexp(b + bad, g)
            ahead[at, 1] = np.logaddexp(b, g + good)
        ahead[at, 1] += score[at]
    for t in range(len(live) - 2, -1, -1):
        at = start[live[t + 1]] + t
        b, g = behind[at + 1, 0], behind[at + 1, 1] + score[at + 1]
        behind[at, 0] = np.logaddexp(b + bad, g)
        behind[at, 1] = np.logaddexp(b, g + good)
    log_z = np.zeros(n)
    some = size > 0
    log_z[some] = np.logaddexp(*ahead[start[some] + size[some] - 1].T)
    z = log_z[doc]
    p = np.exp(ahead[:, 1] + behind[:, 1] - z)
    pair = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, int)
    both_good = np.exp(ahead[pair, 1] + good + score[pair + 1] + behind[pair + 1, 1] - z[pair])
    both_bad = np.exp(ahead[pair, 0] + bad + behind[pair + 1, 0] - z[pair])
    return p, np.bincount(doc[pair], both_good, n), np.bincount(doc[pair], both_bad, n), log_z


def loss_and_gradient(theta, x, doc, label, penalty: float):
    """Penalised negative log likelihood of the texts' labels; ``theta`` ends with the pair weights."""
    import numpy as np
    w, (good, bad) = theta[:-2], theta[-2:]
    score, n = x @ w, len(label)
    p, both_good, both_bad, log_z = forward_backward(score, doc, n, good, bad)
    y = label[doc]
    pairs = np.maximum(np.bincount(doc, minlength=n) - 1, 0)
    right = np.bincount(doc, y * score, n) + pairs * np.where(label > 0, good, bad)
    gradient = np.concatenate([x.T @ (p - y), [(both_good - pairs * label).sum(), (both_bad - pairs * (1 - label)).sum()]])
    return (log_z - right).sum() + penalty / 2 * theta @ theta, gradient + penalty * theta


def minimised(f, theta, rounds: int = 150, memory: int = 8):
    """L-BFGS with a halving line search."""
    import numpy as np
    value, g = f(theta)
    steps: list = []
    for _ in range(rounds):
        d, past = g.copy(), []
        for s, y in reversed(steps):
            a = s @ d / (y @ s)
            past.append(a)
            d -= a * y
        d *= steps[-1][0] @ steps[-1][1] / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(np.abs(g).sum(), 1e-9)
        for (s, y), a in zip(steps, reversed(past)):
            d += (a - y @ d / (y @ s)) * s
        t, slope = 1.0, g @ d
        if slope <= 1e-9:
            break
        while t > 1e-8:
            new_value, new_g = f(theta - t * d)
            if new_value <= value - 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, y = -t * d, new_g - g
        if s @ y > 1e-12:
            steps = [*steps[1 - memory:], (s, y)]
        done = value - new_value < 1e-7 * (abs(value) + 1)
        theta, value, g = theta + s, new_value, new_g
        if done:
            break
    return theta


def fit_field(x, doc, label, penalty: float = 1.0) -> Field:
    """The chain that fits texts whose lines all have the text's label."""
    import numpy as np
    theta = minimised(lambda t: loss_and_gradient(t, x, doc, label, penalty), np.zeros(x.shape[1] + 2))
    return Field(theta[:-2], float(theta[-2]), float(theta[-1]))


def held_out(id_col):
    """Documents whose labels are never learnt from: CRC-32 of the decimal id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_labelled: int = 4000, max_lines: int = 64) -> Field:
    """Fit the chain on at most ``max_labelled`` labelled documents that aren't held out.

    Of a longer document ``max_lines`` neighbouring lines, at a place chosen by its
    id's hash, enter the fit; the driver receives at most ``max_labelled`` x
    ``max_lines`` lines.
    """
    import numpy as np
    rows = labelled_rows(docs, labels.filter(~held_out(F.col("doc_id"))), label_col, max_labelled)
    width = len(feature_names())

    def encode(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        hasher = Hasher(13)
        for b in batches:
            ids, labels = b.column("doc_id").to_pylist(), b.column("label").to_pylist()
            doc, _, x = line_features(b.column("text").to_pylist(), hasher)
            start, size, _ = chains(doc, len(ids))
            out = []
            for k, i in enumerate(ids):
                at = start[k] + zlib.crc32(str(i).encode()) % max(1, size[k] - max_lines + 1)
                out.append(x[at:min(at + max_lines, start[k] + size[k])].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([int(v > 0) for v in labels], pa.int32()), pa.array(out, pa.binary())],
                                             names=["doc_id", "y", "x"])

    got = sorted(rows.select("doc_id", "text", "label").mapInArrow(encode, "doc_id long, y int, x binary").collect(), key=lambda r: r.doc_id)
    label = np.array([r.y for r in got], float)
    if len(set(label.tolist())) < 2:
        return Field(np.zeros(width), share=float(label.mean()) if len(label) else 0.5)
    parts = [np.frombuffer(r.x, np.float32).reshape(-1, width) for r in got]
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return fit_field(np.concatenate(parts).astype(float), doc, label)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
                  **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, n_lines, good_lines``.

    ``score`` is the mean probability of the lines to be good, weighted by their
    bytes, from 0 to 1; ``predicted`` is 1 from ``threshold`` on; ``good_lines``
    counts the lines with a probability of at least 1/2.  ``options`` go to :func:`train`.

    Defined cases: a null, empty or blank text is one blank line; rows that
    repeat an id are scored one by one; a null id isn't held out; null labels,
    labels of unknown ids and of held-out documents aren't learnt from; without labels of both kinds every score is the
    share of label 1 (0.5 without any); an empty table gives no rows; further
    columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels, **options))

    def score(batches):
        import numpy as np
        import pyarrow as pa
        hasher, m = Hasher(13), model.value
        for ids, texts in text_slices(batches, 1 << 20):
            doc, weight, x = line_features(texts, hasher)
            if m.share is None:
                p = forward_backward(x @ m.weights, doc, len(texts), m.good, m.bad)[0]
            else:
                p = np.full(len(doc), m.share)
            mean = np.clip(np.bincount(doc, p * weight, len(texts)) / np.bincount(doc, weight, len(texts)), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(mean), pa.array((mean >= threshold).astype(np.int32)),
                 pa.array(np.bincount(doc, minlength=len(texts)), pa.int64()), pa.array(np.bincount(doc, p >= 0.5, len(texts)).astype(np.int64))],
                names=["doc_id", "score", "predicted", "n_lines", "good_lines"])

    scored = rows.mapInArrow(score, "doc_id long, score double, predicted int, n_lines long, good_lines long")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_lines", "good_lines")
