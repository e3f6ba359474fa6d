"""Elastic-net logistic regression along a path of penalties.

Iteratively reweighted least squares: a Spark job sums the weighted Gram matrix
of the standardised features, 36 x 36 numbers for 34 of them whatever the number of
rows, and coordinate descent on the driver solves the penalised least squares from it.  The rows are kept
in blocks that hold the features one after the other, which a job multiplies one at a time.  The penalties fall
from the one at which every coefficient is zero, each fit starting from the one before.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlab.operators.boosting import filled

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed copy


BLOCK = 1 << 12  # rows of one block


@dataclass
class Point:
    """One penalty of the path: its coefficients on the original scale, the deviance and the IRLS rounds."""

    penalty: float
    intercept: float
    coefficients: list[float]
    deviance: float
    rounds: int


@dataclass
class Path:
    features: list[str]
    alpha: float
    null_deviance: float
    points: list[Point] = field(default_factory=list)

    def at(self, penalty: float | None = None) -> Point:
        """The point of a penalty, by default of the smallest."""
        return self.points[-1] if penalty is None else min(self.points, key=lambda p: abs(p.penalty - penalty))


def blocks(rows: DataFrame) -> RDD:
    """The rows (``y`` and the array ``x``) as kept blocks: labels, and per feature its values, or where that is
    shorter its distinct values and their numbers.

    A task reads one block at a time.  As rows of a table the blocks would come in batches of
    many, which a task would hold more than once.
    """
    def run(batches):
        import pickle

        import numpy as np
        import pyarrow as pa
        for b in batches:
            y = b.column("y").to_numpy()
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).T
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((np.array(y[i:i + BLOCK]), [numbered(c) for c in x[:, i:i + BLOCK]]), 5)
                                                        for i in range(0, len(y), BLOCK)], pa.binary())], names=["block"])

    return rows.mapInArrow(run, "block binary").rdd.map(lambda r: bytes(r.block)).persist(StorageLevel.MEMORY_AND_DISK)


def numbered(column) -> tuple:
    """A column of up to ``BLOCK`` values as its distinct values and a number per row; with None for the numbers, its values."""
    import numpy as np
    values, number = np.unique(column.view(np.int64), return_inverse=True)  # by their bits: nothing is rounded, -0.0 stays
    if 8 * len(values) + (1 if len(values) <= 256 else 2) * len(column) >= 8 * len(column):
        return np.array(column), None
    return values.view(np.float64), number.astype(np.uint8 if len(values) <= 256 else np.uint16)


def gram(table: RDD, mean, sd, weights) -> tuple:
    """Of the rows with an intercept and a working response behind their standardised features: the
    weighted Gram matrix, the deviance and the number of rows, at the given weights (intercept first)."""
    import numpy as np
    size = len(weights) + 1

    def run(found):
        import pickle

        import numpy as np
        total, deviance, n = np.zeros((size, size)), 0.0, 0
        for y, columns in map(pickle.loads, found):
            full = np.ones((size, len(y)))
            for j, (values, number) in enumerate(columns):
                own = (values - mean[j]) / sd[j]
                full[j + 1] = own if number is None else own.take(number)
            eta = weights @ full[:-1]
            p = np.clip(1 / (1 + np.exp(-np.clip(eta, -500, 500))), 1e-10, 1 - 1e-10)
            w = np.maximum(p * (1 - p), 1e-9)
            full[-1] = eta + (y - p) / w
            total += (full * w) @ full.T
            deviance += -2 * float(np.where(y > 0, np.log(p), np.log1p(-p)).sum())
            n += len(y)
        yield np.concatenate([total.ravel(), [deviance, n]])

    parts = table.mapPartitions(run).collect()  # a matrix per task
    flat = np.sum(parts, axis=0) if parts else np.zeros(size * size + 2)
    return flat[:-2].reshape(size, size), flat[-2], int(flat[-1])


def descend(g, n: float, start, l1: float, l2: float, tolerance: float = 1e-10, rounds: int = 10_000):
    """Coordinate descent on the quadratic with Gram matrix ``g`` over n rows: least squares / (2 n) + l1 |b| + l2 b^2 / 2.

    The intercept, first, has no penalty; the last row of ``g`` belongs to the response.
    """
    import numpy as np
    a, c, b = g[:-1, :-1] / n, g[:-1, -1] / n, np.array(start, float)
    for _ in range(rounds):
        largest = 0.0
        for j in range(len(b)):
            rest = c[j] - a[j] @ b + a[j, j] * b[j]
            new = rest / a[j, j] if j == 0 else math.copysign(max(abs(rest) - l1, 0), rest) / (a[j, j] + l2) if a[j, j] + l2 > 0 else 0.0
            largest = max(largest, abs(new - b[j]))
            b[j] = new
        if largest < tolerance:
            break
    return b


def fit_path(train: DataFrame, features: Sequence[str], label: str = "reordered", alpha: float = 0.5, penalties: Sequence[float] | None = None,
             steps: int = 20, least: float = 1e-3, rounds: int = 50, tolerance: float = 1e-7) -> Path:
    """Elastic-net logistic regression for every penalty of a path, the largest first.

    The objective of a penalty is deviance / (2 n) + penalty (alpha |b| + (1 - alpha) b^2 / 2)
    over the coefficients of features with mean 0 and variance 1.  Without ``penalties`` there are ``steps`` of them, equally
    spaced by their logarithm, from the smallest that leaves all coefficients zero down to ``least`` of it.  NULL features count as
    0, rows with a NULL label are left out, a constant feature has the coefficient 0.  Raises ``ValueError`` without labels of both kinds.
    """
    import numpy as np
    features = list(features)
    rows = train.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), F.array(*[filled(c) for c in features]).alias("x"))
    s = rows.agg(F.avg("y").alias("y"), *[f(F.col("x")[i]).alias(f"{k}{i}") for i in range(len(features)) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if s.y is None or not 0 < s.y < 1:
        raise ValueError("the labels must be of both kinds")
    mean, sd = (np.array([s[f"{k}{i}"] for i in range(len(features))]) for k in "ms")
    constant = sd <= 1e-12 * np.maximum(np.abs(mean), 1)
    sd = np.where(constant, np.inf, sd)  # such a column is zero and stays out
    table = blocks(rows)
    weights = np.zeros(len(features) + 1)
    weights[0] = math.log(s.y / (1 - s.y))
    g, null_deviance, n = gram(table, mean, sd, weights)
    path = Path(features, alpha, float(null_deviance))
    if penalties is None:
        # the gradient at the null model: X'W(z - eta) / n, eta being the intercept for all rows
        top = float(np.abs(g[1:-1, -1] - g[1:-1, 0] * weights[0]).max()) / n / max(alpha, 1e-3)
        penalties = [top * least ** (k / max(steps - 1, 1)) for k in range(steps)]
    for penalty in sorted(penalties, reverse=True):
        for done in range(1, rounds + 1):
            new = descend(g, n, weights, penalty * alpha, penalty * (1 - alpha))
            moved = float(np.abs(new - weights).max())
            weights = new
            g, deviance, n = gram(table, mean, sd, weights)
            if moved < tolerance:
                break
        own = np.where(constant, 0.0, weights[1:] / sd)
        path.points.append(Point(float(penalty), float(weights[0] - own @ np.where(constant, 0.0, mean)), own.tolist(), float(deviance), done))
    table.unpersist()
    return path


def predict(path: Path, df: DataFrame, keep: Sequence[str] = (), penalty: float | None = None, name: str = "score") -> DataFrame:
    """The ``keep`` columns and the probability of label 1 at a penalty of the path (the smallest by default)."""
    p = path.at(penalty)
    eta = F.lit(p.intercept)
    for c, b in zip(path.features, p.coefficients):
        if b:
            eta = eta + filled(c) * F.lit(b)
    return df.select(*keep, (1 / (1 + F.exp(-eta))).alias(name))


def history(spark: SparkSession, path: Path) -> DataFrame:
    """Per penalty the IRLS rounds, the coefficients that aren't zero, the deviance and the share of the null deviance explained."""
    rows = [(k + 1, p.penalty, p.rounds, sum(b != 0 for b in p.coefficients), p.deviance, 1 - p.deviance / path.null_deviance)
            for k, p in enumerate(path.points)]
    return spark.createDataFrame(rows, "step int, penalty double, rounds int, nonzero int, deviance double, explained double")


def coefficients(spark: SparkSession, path: Path) -> DataFrame:
    """One row per penalty and feature; the intercept has a NULL feature."""
    rows = [(p.penalty, f, b) for p in path.points for f, b in ((None, p.intercept), *zip(path.features, p.coefficients))]
    return spark.createDataFrame(rows, "penalty double, feature string, coefficient double")
