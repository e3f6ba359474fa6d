"""Toxicity by a classifier chain.

The chain predicts one toxicity category after the other with linear
(logistic) models.  A later link sees the word features and the probabilities
of all earlier categories; it is trained on *out-of-fold* predictions of the
earlier links, so that it meets probabilities as unsure as those at scoring
time.  The last category is ``toxic`` itself, known from the labelled rows;
the earlier ones are toxic documents that hold a seed word of the category.

Features are whole words and word beginnings, present or absent, so that
inflected and compounded forms of a stem count alike.  They are chosen by their
association with the label in the labelled rows.  Scoring reads whole texts.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from basketlab.llm.common import id_and_text, text_slices, written

# Seed words of the categories that come before "toxic" in the chain.
SEEDS = {
    "insult": ["idiot", "moron", "stupid", "clown", "loser", "fool", "dumb"],
    "contempt": ["worthless", "pathetic", "scum", "trash", "disgusting", "garbage", "filth", "vermin"],
}
LAST = "toxic"
BEGINNINGS = (4, 5, 6)  # lengths of the word beginnings used as features
FOLDS = 5


def word_splitter():
    import re
    return re.compile(r"[^\W\d_]+").findall


def features_of(words: set[str]) -> set[str]:
    """Whole words (ending in a space) and their beginnings."""
    return {w + " " for w in words}.union(*({w[:n] for w in words if len(w) > n} for n in BEGINNINGS))


@dataclass
class Chain:
    """A fitted chain: feature column of each feature, one weight vector per category.

    A weight vector holds the bias, the feature weights and the weights of the
    earlier links' logits.
    """

    categories: list[str]
    columns: dict[str, int]
    weights: list


def sigmoid(z):
    import numpy as np
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x, y, penalty: float = 0.1, rounds: int = 20):
    """Weights (bias first) of a ridge-penalised logistic regression, by Newton steps."""
    import numpy as np
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    ridge = np.full(a.shape[1], penalty)
    ridge[0] = 1e-3
    for _ in range(rounds):
        p = sigmoid(a @ w)
        grad = a.T @ (y - p) - ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), grad)
        w += step
        if abs(step).max() < 1e-4:
            break
    return w


def fit_chain(x, targets, folds):
    """Weight vectors of the links; ``targets`` has a column per category, in chain order."""
    import numpy as np
    inputs, weights = x, []
    for y in targets.T:
        held_out = np.zeros(len(x))
        for k in range(FOLDS):
            test = folds == k
            if test.any() and not test.all():
                w = fit_logistic(inputs[~test], y[~test])
                held_out[test] = w[0] + inputs[test] @ w[1:]
        weights.append(fit_logistic(inputs, y))
        inputs = np.hstack([inputs, sigmoid(held_out)[:, None]])
    return weights


def chain_probabilities(weights, x):
    """Probability of every category, a column each."""
    import numpy as np
    inputs = x
    for w in weights:
        inputs = np.hstack([inputs, sigmoid(w[0] + inputs @ w[1:])[:, None]])
    return inputs[:, x.shape[1]:]


def labelled_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_labelled: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``max_labelled`` labelled ids (chosen by hash), a row per id.

    Of the rows that repeat an id the one with the smallest hash of its text stands for it.
    """
    known = (labels.select(F.col("doc_id").alias("id"), F.col(label_col).alias("label"))
             .filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label")))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)  # bounded, so it may be broadcast
    rows = docs.join(F.broadcast(chosen), docs.doc_id == chosen.id).select("doc_id", "text", "label")
    first = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text")))  # map-side, so a hot id moves one text per task
    return written(rows.groupBy("doc_id").agg(first.alias("text"), F.max("label").alias("label")), "labelled")


def choose_features(rows: DataFrame, positives: int, negatives: int, max_features: int, min_rows: int) -> list[str]:
    """The features with the strongest association with the label (chi-square), seen in ``min_rows`` positives."""
    def count(batches):
        import pyarrow as pa
        split, seen = word_splitter(), {0: Counter(), 1: Counter()}
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                seen[int(label > 0)].update(features_of(set(split(text.lower()))))
        own = list(seen[1])  # only features of positive rows can be associated with the label
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([seen[1][f] for f in own], pa.int64()),
                                          pa.array([seen[0][f] for f in own], pa.int64())], names=["f", "pos", "neg"])
        rest = [f for f in seen[0] if f not in seen[1]]
        yield pa.RecordBatch.from_arrays([pa.array(rest, pa.string()), pa.array([0] * len(rest), pa.int64()),
                                          pa.array([seen[0][f] for f in rest], pa.int64())], names=["f", "pos", "neg"])

    total = (rows.select("text", "label").mapInArrow(count, "f string, pos long, neg long")
             .groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter(F.col("pos") >= min_rows))
    a, b = F.col("pos").cast("double"), F.col("neg").cast("double")
    rate_p, rate_n = a / positives, b / max(negatives, 1)
    pooled = (a + b) / (positives + negatives)
    chi = (rate_p - rate_n) ** 2 / (pooled * (1 - pooled) + 1e-9)
    best = total.filter(rate_p > 3 * rate_n).orderBy(chi.desc(), "f").limit(max_features)
    return sorted(r.f for r in best.collect())


def present(texts: list[str], columns: dict[str, int], split):
    """0/1 matrix of the features in whole texts."""
    import numpy as np
    whole = {f[:-1]: i for f, i in columns.items() if f.endswith(" ")}
    begin = {n: {f: i for f, i in columns.items() if len(f) == n and not f.endswith(" ")} for n in BEGINNINGS}
    x = np.zeros((len(texts), len(columns)))
    for row, text in zip(x, texts):
        words = set(split(text.lower()))
        for w in words & whole.keys():
            row[whole[w]] = 1
        for n, of in begin.items():
            if of:
                for w in {w[:n] for w in words} & of.keys():
                    row[of[w]] = 1
    return x


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", seeds: dict[str, list[str]] = SEEDS,
          max_labelled: int = 10_000, max_features: int = 256, min_rows: int = 3) -> Chain | None:
    """Fit the chain on at most ``max_labelled`` labelled documents; None without both kinds of label.

    ``docs`` has ``doc_id, text``; rows that repeat an id count as one.  Feature statistics come from a Spark
    aggregation; the driver receives the 0/1 features of the labelled rows,
    at most ``max_labelled`` x ``max_features``.
    """
    import numpy as np
    rows = labelled_rows(docs, labels, label_col, max_labelled)
    sizes = {r.y: r.n for r in rows.groupBy((F.col("label") > 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    # words that mark a beginning: a feature is the text up to `BEGINNINGS` characters, or the word and a space
    columns = {f: i for i, f in enumerate(choose_features(rows, sizes[True], sizes[False], max_features, min_rows))}
    categories = [*seeds, LAST]

    def encode(batches):
        import pyarrow as pa
        split = word_splitter()
        for b in batches:
            texts = b.column("text").to_pylist()
            words = [set(split(t.lower())) for t in texts]
            seeded = [[int(not w.isdisjoint(seeds[c])) for c in seeds] for w in words]
            on = [np.flatnonzero(r).astype(np.int32) for r in present(texts, columns, split)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([int(v > 0) for v in b.column("label").to_pylist()], pa.int32()),
                 pa.array(seeded, pa.list_(pa.int32())), pa.array(on, pa.list_(pa.int32()))],
                names=["doc_id", "y", "seeded", "present"])

    own = rows.mapInArrow(encode, "doc_id long, y int, seeded array<int>, present array<int>")
    got = sorted(own.select("y", "seeded", "present", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).alias("fold"),
                            "doc_id").collect(), key=lambda r: (r.doc_id, r.y, r.present))
    x = np.zeros((len(got), len(columns)))
    for row, r in zip(x, got):
        row[r.present] = 1
    y = np.array([r.y for r in got], float)
    targets = np.stack([*(y * np.array([r.seeded[j] for r in got]) for j in range(len(seeds))), y], axis=1)
    return Chain(categories, columns, fit_chain(x, targets, np.array([r.fold for r in got])))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.5, **options) -> DataFrame:
    """One row per document: ``doc_id``, ``p_<category>`` of each link and ``toxic``.

    ``toxic`` is true where the last link's probability is ``threshold`` or
    more.  ``options`` go to :func:`train`.  Defined cases: a null text counts
    as empty; null labels and labels of unknown ids are left out of the
    training; without labels of both kinds every probability is 0 and nothing
    is toxic; an empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    chain = train(rows, labels, **options)
    names = [*options.get("seeds", SEEDS), LAST]
    schema = "doc_id long, " + "".join(f"p_{c} double, " for c in names) + "toxic boolean"
    model = docs.sparkSession.sparkContext.broadcast(chain)

    def score(batches):
        import numpy as np
        import pyarrow as pa
        split, m = word_splitter(), model.value
        for ids, texts in text_slices(batches):
            p = np.zeros((len(ids), len(names)))
            if m is not None:
                p = chain_probabilities(m.weights, present(texts, m.columns, split))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c) for c in p.T.copy()),
                 pa.array((p[:, -1] >= threshold) & (m is not None))],
                names=["doc_id", *(f"p_{c}" for c in names), "toxic"])

    return rows.mapInArrow(score, schema)
