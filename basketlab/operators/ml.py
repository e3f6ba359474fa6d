"""Model training, scoring and inspection with Spark ML.

The boosted learners of the reference are the second-order booster of
``boosting.py``; Spark ML's ``GBTClassifier``, ``RandomForestClassifier`` and
``LogisticRegression`` stand beside it as plain learners.
Training reads an already materialised matrix (a checkpoint or a written
table), so an executor loss re-reads files instead of recomputing features.
"""

from __future__ import annotations

import dataclasses
import json
import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from basketlab.operators import boosting as BO, metrics as MT
from basketlab.session import materialize

LABEL = "reordered"
BOOSTED = ("boosted", "boosted_forest", "leaf_wise", "boosted_machine")  # algorithms of the second-order booster
KEYS = ("user_id", "product_id")

# The boosted-tree parameters of the reference's final model.
REFERENCE_BOOSTER_PARAMS = {
    "max_depth": 1, "min_child_weight": 389, "gamma": 438, "eta": 0.0907183045377987,
    "subsample": 0.10741019033611729, "colsample_bytree": 0.336917979846298,
    "colsample_bylevel": 0.118177830385349, "lambda": 11, "alpha": 89,
    "objective": "binary:logistic", "rounds": 500, "early_stopping_rounds": 30,
}


@dataclass
class Preset:
    """An algorithm and its Spark ML parameters."""

    algorithm: str
    params: dict = field(default_factory=dict)
    unmapped: dict = field(default_factory=dict)

    def estimator(self, features_col: str = "features", label_col: str = "label", **extra):
        kw = dict(featuresCol=features_col, labelCol=label_col, **self.params, **extra)
        if self.algorithm in ("gbt", "gbt_alt"):
            return GBTClassifier(**kw)
        if self.algorithm == "rf":
            return RandomForestClassifier(**kw)
        if self.algorithm == "glm":
            return LogisticRegression(**kw)
        raise ValueError(f"unknown algorithm {self.algorithm!r}")


# The learners' parameter names with the fields of ``boosting.Params`` (None: no effect here).
BOOSTER_NAMES = {
    "rounds": "rounds", "num_boost_round": "rounds", "max_depth": "max_depth", "eta": "eta", "learning_rate": "eta", "subsample": "subsample",
    "colsample_bytree": "colsample_bytree", "colsample_bylevel": "colsample_bylevel", "min_child_weight": "min_child_weight",
    "gamma": "gamma", "lambda": "lambda_", "alpha": "alpha", "max_bin": "max_bins", "max_leaves": "max_leaves",
    "num_parallel_tree": "trees_per_round", "base_score": "base_score", "seed": "seed", "early_stopping_rounds": "patience",
    "objective": None, "eval_metric": None, "booster": None, "tree_method": None, "device": None, "nthread": None, "verbose": None,
}
LEAF_WISE_NAMES = {
    "rounds": "rounds", "num_leaves": "max_leaves", "max_depth": "max_depth", "learning_rate": "eta", "bagging_fraction": "subsample",
    "feature_fraction": "colsample_bytree", "min_data_in_leaf": "min_child_rows", "min_sum_hessian_in_leaf": "min_child_weight",
    "min_gain_to_split": "gamma", "lambda_l1": "alpha", "lambda_l2": "lambda_", "max_bin": "max_bins", "seed": "seed",
    "early_stopping_rounds": "patience", "objective": None, "metric": None, "verbose": None, "bagging_freq": None,
}
MACHINE_NAMES = {
    "rounds": "rounds", "ntrees": "rounds", "max_depth": "max_depth", "learn_rate": "eta", "sample_rate": "subsample",
    "col_sample_rate": "colsample_bylevel", "col_sample_rate_per_tree": "colsample_bytree", "min_rows": "min_child_rows",
    "nbins": "max_bins", "min_split_improvement": "gamma", "seed": "seed", "stopping_rounds": "patience",
    "stopping_metric": None, "distribution": None,
}
# What the learners do where a parameter isn't given.
LEAF_WISE_DEFAULTS = dict(rounds=500, growth="leaf", max_leaves=31, max_depth=0, eta=0.1, lambda_=0.0, min_child_weight=1e-3, min_child_rows=20,
                          max_bins=255, base_score=None, patience=30)
MACHINE_DEFAULTS = dict(rounds=50, max_depth=5, eta=0.1, lambda_=0.0, min_child_weight=0.0, min_child_rows=10, gamma=1e-5, max_bins=20,
                        base_score=None, patience=None)
LINEAR_NAMES = {
    "lambda": ("regParam", float), "alpha": ("elasticNetParam", float), "max_iterations": ("maxIter", int),
    "standardize": ("standardization", bool), "intercept": ("fitIntercept", bool), "family": None, "seed": None,
}


def with_params(preset: Preset, params: dict | None, names: dict) -> Preset:
    """M7: ``params`` under a learner's own names over a preset's defaults.

    Names without a twin in Spark ML are listed in ``Preset.unmapped`` (and
    logged with a run); unknown names raise ``ValueError``.
    """
    _known(params, names)
    own, unmapped = dict(preset.params), dict(preset.unmapped)
    for k, v in (params or {}).items():
        if names[k] is None:
            unmapped[k] = v
        else:
            own[names[k][0]] = names[k][1](v)
    return Preset(preset.algorithm, own, unmapped)


def _known(params: dict | None, names: dict) -> None:
    if unknown := set(params or {}) - set(names):
        raise ValueError(f"unknown parameter(s): {', '.join(sorted(unknown))}")


def boosted_preset(algorithm: str, params: dict | None, names: dict, **defaults) -> Preset:
    """M7: a preset of the second-order booster from a learner's own parameter names."""
    _known(params, names)
    own, unmapped = dict(defaults), {}
    for k, v in (params or {}).items():
        if names[k] is None:
            unmapped[k] = v
        else:
            own[names[k]] = max(0, v) if names[k] == "max_depth" else v  # some learners write "no limit" as -1
    if own.get("patience") == 0:
        own["patience"] = None
    return Preset(algorithm, dataclasses.asdict(BO.Params(**own)), unmapped)


def booster_preset(max_iter: int | None = None, params: dict | None = None) -> Preset:
    """M2/M6: the reference's boosted-tree parameters, changed by ``params``."""
    own = {**REFERENCE_BOOSTER_PARAMS, **(params or {})}
    if max_iter is not None:
        own["rounds"] = max_iter
    return boosted_preset("boosted", own, BOOSTER_NAMES)


PRESETS = {
    "gbt": lambda n=50: Preset("gbt", dict(maxIter=n, maxDepth=4, stepSize=0.1, lossType="logistic", seed=42)),
    "gbt_alt": lambda n=20: Preset("gbt_alt", dict(maxIter=n, maxDepth=6, stepSize=0.05, subsamplingRate=0.8,
                                                   featureSubsetStrategy="0.8", minInstancesPerNode=20, seed=7)),
    "rf": lambda n=100: Preset("rf", dict(numTrees=n, maxDepth=6, featureSubsetStrategy="onethird",
                                         subsamplingRate=0.8, seed=42)),
    "glm": lambda n=50: Preset("glm", dict(maxIter=n, regParam=0.01, elasticNetParam=0.5, standardization=True)),
}


def feature_columns(df: DataFrame, label: str = LABEL, include_keys: bool = False) -> list[str]:
    """M1: numeric feature names of a matrix (keys excluded unless asked)."""
    skip = {label, "label", "fold", "is_validation"} | (set() if include_keys else set(KEYS))
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, T.NumericType)]


def prepare(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """M1: ``label`` as double plus the features; missing feature values become 0."""
    return (df.withColumn("label", F.col(label).cast("double"))
            .na.fill(0.0, subset=list(features)))


def fit(train: DataFrame, preset: Preset, features: Sequence[str], label: str = LABEL) -> PipelineModel:
    """M2-M6: fit ``VectorAssembler -> estimator`` on a matrix."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[asm, preset.estimator()]).fit(prepare(train, features, label))


def gradient_params(preset: Preset) -> BO.Params:
    """The booster's parameters of Spark ML's ``GBTClassifier`` with the logistic loss.

    With labels of -1 and 1 and the log odds at 2 F, its residuals are -4 (p - y) and the margin is 2 F: a leaf's mean
    residual times the step is -8 step G / n.  Its first tree has the labels' means, -2 G / n, and a weight of 1.  The
    gain in variance is that of a hessian of 1 per row.
    """
    p = dict(preset.params)
    if p.pop("lossType", "logistic") != "logistic" or set(p) - {"maxIter", "maxDepth", "stepSize", "seed"}:
        raise ValueError("only the rounds, depth, step and seed can be given")
    return BO.Params(rounds=p["maxIter"], max_depth=p["maxDepth"], eta=8 * p["stepSize"], eta_first=4.0, newton=False, lambda_=0.0, min_child_weight=0.0,
                     max_bins=32, cuts="middle", patience=None, seed=p["seed"])


def fit_scaled(train: DataFrame, preset: Preset, features: Sequence[str], label: str = LABEL) -> PipelineModel | BO.Ensemble:
    """:func:`fit`, but gradient-boosted trees are grown by the booster's histograms: the same trees, if the cuts are the same, from a byte per value."""
    if preset.algorithm == "gbt":
        return BO.fit_boosted(train, features, gradient_params(preset), label)
    return fit(train, preset, features, label)


def trees_built(model: PipelineModel | BO.Ensemble) -> int:
    if isinstance(model, BO.Ensemble):
        return len(model.trees)
    est = model.stages[-1]
    return int(est.getNumTrees) if hasattr(est, "getNumTrees") else 0


def score(model: PipelineModel | BO.Ensemble, df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """(keys, label, score) with score = P(label = 1)."""
    keep = [c for c in KEYS if c in df.columns]
    if isinstance(model, BO.Ensemble):
        rows = df.withColumn("label", F.col(label).cast("int"))
        return BO.predict(model, rows, [*keep, "label"]).drop("margin")
    out = model.transform(prepare(df, features, label))
    return out.select(*keep, F.col("label").cast("int").alias("label"),
                      vector_to_array("probability")[1].alias("score"))


def evaluate(scored: DataFrame, threshold: float = MT.THRESHOLD) -> DataFrame:
    """All metrics of the scored rows, whose labels and scores are written once: each of the aggregations would score them again."""
    return MT.all_metrics(materialize(scored.select("label", "score"), "scored"), "label", "score", threshold)


def train_and_evaluate(train: DataFrame, test: DataFrame, preset: Preset, label: str = LABEL) -> DataFrame:
    """Fit on ``train``, score ``test`` (``train`` when ``test`` is None), one metrics row."""
    feats = feature_columns(train, label)
    model = fit_scaled(train, preset, feats, label)
    scored = score(model, test if test is not None else train, feats, label)
    return evaluate(scored).select(F.lit(preset.algorithm).alias("algorithm"), "*")


def cross_validate(matrix: DataFrame, preset: Preset, folds: int = 3, label: str = LABEL) -> DataFrame:
    """M9: fold = pmod(user_id, folds); train on the other folds, evaluate on each fold.

    :func:`continued` trains on from fold to fold instead.
    """
    m = assign_folds(matrix, folds)
    feats = feature_columns(m, label)
    parts = []
    for k in range(folds):
        model = fit_scaled(m.filter(F.col("fold") != k), preset, feats, label)
        scored = score(model, m.filter(F.col("fold") == k), feats, label)
        parts.append(evaluate(scored).select(F.lit(k).alias("fold"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def continued(matrix: DataFrame, evaluation: DataFrame, params: BO.Params, folds: int = 3,
              label: str = LABEL) -> tuple[list[BO.Ensemble], DataFrame]:
    """M9: one booster trained on from fold to fold, stopped by the loss on ``evaluation``.

    Returns the model after each fold and one row per fold: its rows, the
    trees in all, those that count, and the loss on ``evaluation`` before and after.
    """
    m = assign_folds(matrix, folds)
    feats = feature_columns(m, label)
    parts = [m.filter(F.col("fold") == k) for k in range(folds)]
    models = BO.fit_continued(parts, feats, params, label, evaluation)

    def loss(model) -> float:
        return MT.log_loss(score(model, evaluation, feats, label)).first().logloss

    losses = [loss(x) for x in models]
    rows = [(k, p.count(), len(x.trees), len(x.used), losses[k - 1] if k else None, losses[k]) for k, (p, x) in enumerate(zip(parts, models))]
    return models, matrix.sparkSession.createDataFrame(
        rows, "fold int, rows long, trees_built int, trees_used int, loss_before double, loss_after double")


def assign_folds(df: DataFrame, folds: int = 3) -> DataFrame:
    """Deterministic user-level fold (all lines of a user in one fold)."""
    return df.withColumn("fold", F.pmod(F.col("user_id"), F.lit(folds)).cast("int"))


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Gain (impurity) importance and split count per feature, 0 when unused.

    Split counts are read from the fitted model's tree description (the
    model is driver-side metadata; no data is collected).
    """
    if isinstance(model, BO.Ensemble):
        return BO.importance(spark, model).select(
            "feature", F.col("gain").alias("gain_importance"), "total_gain", F.col("weight").alias("split_count")).orderBy(
            F.desc("gain_importance"), "feature")
    est = model.stages[-1]
    gains = est.featureImportances.toArray() if hasattr(est, "featureImportances") else None
    splits = [0] * len(features)
    if hasattr(est, "toDebugString"):
        for m in re.finditer(r"If \(feature (\d+) ", est.toDebugString):
            splits[int(m.group(1))] += 1
    total = _total_gain(est, len(features))
    rows = [(f, float(gains[i]) if gains is not None else 0.0, total[i], splits[i]) for i, f in enumerate(features)]
    schema = "feature string, gain_importance double, total_gain double, split_count long"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("gain_importance"), "feature")


def _total_gain(est, n: int) -> list[float]:
    """Gain times rows, summed over all splits of all trees, per feature (a tree model's own node table)."""
    total = [0.0] * n
    for tree in getattr(est, "trees", []):
        stack = [tree._call_java("rootNode")]
        while stack:
            node = stack.pop()
            if node.subtreeDepth() > 0:
                total[node.split().featureIndex()] += node.gain() * node.impurityStats().count()
                stack += [node.leftChild(), node.rightChild()]
    return total


def loss_history(spark: SparkSession, model: PipelineModel, data: DataFrame, features: Sequence[str],
                 label: str = LABEL) -> DataFrame:
    """Training loss per iteration (GBT: evaluated on ``data``; GLM: objective history; booster: its evaluation rows)."""
    if isinstance(model, BO.Ensemble):
        return BO.loss_history(spark, model)
    est = model.stages[-1]
    if hasattr(est, "evaluateEachIteration"):
        asm = model.stages[0].transform(prepare(data, features, label))
        losses = est.evaluateEachIteration(asm)
    elif hasattr(est, "summary"):
        losses = est.summary.objectiveHistory
    else:
        losses = []
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(losses)], "iteration int, loss double")


def unused_features(spark: SparkSession, importance: DataFrame, features: Sequence[str]) -> DataFrame:
    """Matrix features with no split in the model (anti join on the name)."""
    names = spark.createDataFrame([(f,) for f in features], "feature string")
    used = importance.filter(F.col("split_count") > 0).select("feature")
    return names.join(used, "feature", "left_anti")


def log_run(spark: SparkSession, runs_path: str, preset: Preset, metrics: DataFrame, seconds: float,
            dataset_version: str = "", model_version: str = "", commit: str = "", experiment: str = "",
            stopped_on_test: bool = False, run_id: str | None = None) -> DataFrame:
    """One run record (params, duration, metrics, versions) in a Parquet table, a folder per run.

    A job that is run again with the ``run_id`` of its first try replaces its
    record; by default each call is a run of its own.

    ``stopped_on_test`` records that the scored rows also chose the number of
    rounds, which flatters the metrics.
    """
    run_id = run_id or uuid.uuid4().hex
    rec = metrics.select(
        F.lit(experiment).alias("experiment"), F.lit(preset.algorithm).alias("algorithm"),
        F.lit(json.dumps(preset.params, sort_keys=True)).alias("params"),
        F.lit(json.dumps(preset.unmapped, sort_keys=True)).alias("unmapped_params"),
        F.lit(stopped_on_test).alias("stopped_on_test"),
        F.lit(float(seconds)).alias("training_seconds"), F.lit(dataset_version).alias("dataset_version"),
        F.lit(model_version).alias("model_version"), F.lit(commit).alias("commit"),
        F.current_timestamp().alias("logged_at"),
        "precision", "recall", "f1", "auc", "logloss")
    rec.write.mode("overwrite").parquet(f"{runs_path.rstrip('/')}/run_id={run_id}")
    return spark.read.parquet(runs_path).filter(F.col("run_id") == run_id)


def timed_fit(train: DataFrame, preset: Preset, features: Sequence[str], label: str = LABEL):
    t0 = time.time()
    model = fit(train, preset, features, label)
    return model, time.time() - t0


class ModelTrainer:
    """M2-M7, M10, M20 under the original trainer's interface.

    Each ``train_*`` fits on ``train_set``, scores ``test_set`` (the train
    set when none is given), appends a run record (parameters, training
    time, precision / recall / F1 / AUC / log loss, versions, commit) to the
    Parquet ``runs`` table of the experiment and returns the fitted model.
    """

    def __init__(self, experiment_name: str, train_set: DataFrame, test_set: DataFrame | None = None,
                 target_column: str = LABEL, runs_path: str | None = None):
        from basketlab.session import scratch_path
        self.experiment_name, self.train_set, self.test_set = experiment_name, train_set, test_set
        self.target_column = target_column
        self.spark = train_set.sparkSession
        self.runs_path = runs_path or scratch_path(self.spark, f"runs_{experiment_name}")
        self.last_run: DataFrame | None = None

    def _run(self, preset: Preset, commit: str, dataset_version: str, model_version: str) -> PipelineModel | BO.Ensemble:
        """M8: boosters stop on the test set's loss, or on the train set's where there is no test set."""
        feats = feature_columns(self.train_set, self.target_column)
        t0, stopped_on_test = time.time(), False
        if preset.algorithm in BOOSTED:
            params = BO.Params(**preset.params)
            stopped_on_test = params.patience is not None and self.test_set is not None
            model = BO.fit_boosted(self.train_set, feats, params, self.target_column, self.test_set)
        else:
            model = fit(self.train_set, preset, feats, self.target_column)
        secs = time.time() - t0
        data = self.test_set if self.test_set is not None else self.train_set
        metrics = evaluate(score(model, data, feats, self.target_column))
        self.last_run = log_run(self.spark, self.runs_path, preset, metrics, secs, dataset_version, model_version,
                                commit, self.experiment_name, stopped_on_test)
        return model

    def train_xgb_gbm(self, prev_commit_hash, dataset_version, model_version, params=None):
        return self._run(booster_preset(params=params), prev_commit_hash, dataset_version, model_version)

    def train_xgb_rf(self, prev_commit_hash, dataset_version, model_version, params=None):
        """As in the original, the booster itself; ``num_parallel_tree`` makes each round a forest."""
        preset = boosted_preset("boosted_forest", {"rounds": 500, "early_stopping_rounds": 30, **(params or {})}, BOOSTER_NAMES)
        return self._run(preset, prev_commit_hash, dataset_version, model_version)

    def train_lgbm(self, prev_commit_hash, dataset_version, model_version, params=None):
        preset = boosted_preset("leaf_wise", params, LEAF_WISE_NAMES, **LEAF_WISE_DEFAULTS)
        return self._run(preset, prev_commit_hash, dataset_version, model_version)

    def train_h2o_glm(self, prev_commit_hash, dataset_version, model_version, params=None):
        preset = with_params(PRESETS["glm"](), params, LINEAR_NAMES)
        return self._run(preset, prev_commit_hash, dataset_version, model_version)

    def train_h2o_gbm(self, prev_commit_hash, dataset_version, model_version, params=None):
        preset = boosted_preset("boosted_machine", params, MACHINE_NAMES, **MACHINE_DEFAULTS)
        return self._run(preset, prev_commit_hash, dataset_version, model_version)
