"""Named queries over the test tables: ``key -> f(spark, sf_dir) -> DataFrame``.

Each query derives the basket star schema from the given parquet tables
(:mod:`basketlab.sources.testdata`) and runs one operator of the library
over all of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from basketlab.functions.skew import skew_join
from basketlab.operators import base as B
from basketlab.operators import eda as E
from basketlab.operators import glm as GLM
from basketlab.operators import metrics as MT
from basketlab.operators import ml as ML
from basketlab.operators import product as P
from basketlab.operators import boosting as BO
from basketlab.operators import streaks as S
from basketlab.operators import time as TM
from basketlab.operators import user as U
from basketlab.operators import user_product as X
from basketlab.plans import matrices as M
from basketlab.plans.features import FeatureSet
from basketlab.schemas import cast_bulk as _cast_bulk, cast_by_type as _cast_by_type
from basketlab.session import materialize, scratch_path
from basketlab.sources.tables import BasketTables
from basketlab.sources.testdata import load_testdata

# Keyword parameters used on the test data.  The library
# defaults ("organic", "asian", "gluten free") never occur in its product
# names, so the registered queries use words that do.
TEST_KEYWORDS = ("red", "cold", "widget")
TEST_ORGANIC_PATTERN = "(?i)red"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def tables(spark: SparkSession, sf_dir: str) -> BasketTables:
    return load_testdata(spark, sf_dir)


_FEATURES: dict[tuple, FeatureSet] = {}


def features(spark: SparkSession, sf_dir: str, **kw) -> tuple[BasketTables, FeatureSet]:
    """The star schema and a FeatureSet over its history, shared per Spark
    application: its materialised intermediates (per-(order, product) table,
    feature tables) are built once and read by every query, as the batch job
    builds both matrices from one set of written feature tables."""
    t = tables(spark, sf_dir)
    kw.setdefault("keywords", TEST_KEYWORDS)
    key = (spark.sparkContext.applicationId, sf_dir, tuple(sorted((k, str(v)) for k, v in kw.items())))
    if key not in _FEATURES:
        _FEATURES[key] = FeatureSet.from_tables(t, **kw)
    return t, _FEATURES[key]


# ---------------------------------------------------------------- sources
@query
def union_history(spark, sf_dir):
    return tables(spark, sf_dir).history_lines()


@query
def split_history(spark, sf_dir):
    return tables(spark, sf_dir).history_orders()


@query
def split_test(spark, sf_dir):
    return tables(spark, sf_dir).test_orders()


@query
def base_lines(spark, sf_dir):
    _, fs = features(spark, sf_dir)
    return fs.base.drop("order_matched")


@query
def base_lines_skewed(spark, sf_dir):
    """J1 with the heavy-hitter join: hot orders are dealt over several tasks."""
    t = tables(spark, sf_dir)
    orders = t.history_orders().select("order_id", *B.ORDER_ATTRS)
    return skew_join(t.history_lines().select(*B.LINE_COLS), orders, ["order_id"], support=0.001)


# ---------------------------------------------------------------- user
@query
def user_reorder_frequency(spark, sf_dir):
    return U.user_reorder_frequency(features(spark, sf_dir)[1].base)


@query
def user_reorder_sum(spark, sf_dir):
    return U.user_reorder_sum(features(spark, sf_dir)[1].base)


@query
def user_peak_hour_count(spark, sf_dir):
    return U.user_peak_hour_count(features(spark, sf_dir)[1].orders)


@query
def user_keyword_orders(spark, sf_dir):
    return U.user_keyword_orders(features(spark, sf_dir)[1].order_stats)


@query
def user_basket_size(spark, sf_dir):
    return U.user_basket_size(features(spark, sf_dir)[1].order_stats)


@query
def user_all_new_orders(spark, sf_dir):
    return U.user_all_new_orders(features(spark, sf_dir)[1].order_stats)


@query
def user_features(spark, sf_dir):
    """The materialised user feature table (built once per application)."""
    return features(spark, sf_dir)[1].feature_tables[0]


# ---------------------------------------------------------------- product
@query
def product_purchase_count(spark, sf_dir):
    return P.product_purchase_count(features(spark, sf_dir)[1].lines)


@query
def product_cart_position(spark, sf_dir):
    return P.product_cart_position(features(spark, sf_dir)[1].lines)


@query
def product_reorder_rate(spark, sf_dir):
    return P.product_reorder_rate(features(spark, sf_dir)[1].lines)


@query
def product_one_shot_users(spark, sf_dir):
    return P.product_one_shot_users(features(spark, sf_dir)[1].op)


@query
def product_cooccurrence(spark, sf_dir):
    return P.product_cooccurrence(features(spark, sf_dir)[1].op)


@query
def product_cooc_per_order(spark, sf_dir):
    return P.product_cooc_per_order(features(spark, sf_dir)[1].op)


@query
def streak_flags(spark, sf_dir):
    return S.streak_flags(features(spark, sf_dir)[1].op)


@query
def streak_lengths(spark, sf_dir):
    return features(spark, sf_dir)[1].streak_lengths("compat")


@query
def streak_islands(spark, sf_dir):
    return features(spark, sf_dir)[1].streak_lengths("island")


@query
def product_streak_stats(spark, sf_dir):
    return S.product_streak_stats(features(spark, sf_dir)[1].streak_lengths("compat")).select(
        "product_id", "Total_streak_of_this_product", "mean_of_streaks_of_this_product",
        "min_of_streaks_of_this_product", "max_of_streaks_of_this_product")


@query
def product_streak_probs(spark, sf_dir):
    return S.product_streak_stats(features(spark, sf_dir)[1].streak_lengths("compat")).select(
        "product_id", "prob_of_reordered_5", "prob_of_reordered_3", "prob_of_reordered_2")


@query
def product_island_stats(spark, sf_dir):
    return S.product_streak_stats(features(spark, sf_dir)[1].streak_lengths("island"))


@query
def order_dow_pivot(spark, sf_dir):
    return P.order_dow_pivot(features(spark, sf_dir)[1].orders)


@query
def product_dow_distribution(spark, sf_dir):
    return P.product_dow_distribution(features(spark, sf_dir)[1].base)


@query
def prod_order_share(spark, sf_dir):
    fs = features(spark, sf_dir)[1]
    return P.prod_order_share(fs.lines, fs.orders)


@query
def product_features(spark, sf_dir):
    """The materialised product feature table (built once per application)."""
    return features(spark, sf_dir)[1].feature_tables[1]


# ---------------------------------------------------------------- user x product
@query
def up_order_count(spark, sf_dir):
    return X.up_order_count(features(spark, sf_dir)[1].base)


@query
def up_cart_position(spark, sf_dir):
    return X.up_cart_position(features(spark, sf_dir)[1].base)


@query
def up_cooccurrence(spark, sf_dir):
    return X.up_cooccurrence(features(spark, sf_dir)[1].op)


@query
def user_product_features(spark, sf_dir):
    """The materialised user x product feature table (built once per application)."""
    return features(spark, sf_dir)[1].feature_tables[2]


# ---------------------------------------------------------------- time, matrices
@query
def orders_per_dow(spark, sf_dir):
    return TM.orders_per_dow(features(spark, sf_dir)[1].orders)


@query
def orders_per_hour(spark, sf_dir):
    return TM.orders_per_hour(features(spark, sf_dir)[1].orders)


@query
def time_features(spark, sf_dir):
    return features(spark, sf_dir)[1].time_features()


@query
def time_means(spark, sf_dir):
    return features(spark, sf_dir)[1].time_means()


@query
def train_matrix(spark, sf_dir):
    return features(spark, sf_dir)[1].train_matrix()


@query
def test_candidates(spark, sf_dir):
    return M.test_candidates(tables(spark, sf_dir))


def _test_matrix(spark, sf_dir, how):
    t, fs = features(spark, sf_dir)
    return M.test_matrix(*fs.feature_tables, fs.orders, M.test_candidates(t), how=how)


@query
def test_matrix(spark, sf_dir):
    return _test_matrix(spark, sf_dir, "left")


@query
def test_matrix_inner(spark, sf_dir):
    return _test_matrix(spark, sf_dir, "inner")


@query
def labelled_candidates(spark, sf_dir):
    t = tables(spark, sf_dir)
    return M.labelled_candidates(t, M.test_candidates(t))


# ---------------------------------------------------------------- exploratory statistics


def _source_tables(t: BasketTables) -> dict[str, DataFrame]:
    return {"order_products__prior": t.prior_lines, "orders": t.orders,
            "order_products__train": t.train_lines, "products": t.products,
            "aisles": t.aisles, "departments": t.departments}


@query
def null_profile(spark, sf_dir):
    return E.null_profile(_source_tables(tables(spark, sf_dir)))


@query
def null_after_first(spark, sf_dir):
    return E.null_after_first(tables(spark, sf_dir).orders)


@query
def distinct_counts(spark, sf_dir):
    t = tables(spark, sf_dir)
    return E.distinct_counts([
        ("order_products__prior", t.prior_lines, "reordered"),
        ("order_products__train", t.train_lines, "reordered"),
        ("orders", t.orders, "eval_set"),
        ("test_orders", t.test_orders(), "user_id"),
    ])


@query
def distinct_values(spark, sf_dir):
    return E.distinct_values(tables(spark, sf_dir).orders, ["eval_set", "order_dow", "order_hour_of_day"])


@query
def column_extrema(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t.orders.agg(F.max("days_since_prior_order").alias("max_days_since_prior_order"),
                        F.max("order_number").alias("max_order_number"),
                        F.count(F.lit(1)).alias("n_orders"),
                        t.test_orders().select(F.count(F.lit(1))).scalar().alias("n_test_orders"))


@query
def value_counts_reordered(spark, sf_dir):
    return E.value_counts(tables(spark, sf_dir).prior_lines, "reordered")


@query
def value_counts_eval_set(spark, sf_dir):
    return E.value_counts(tables(spark, sf_dir).orders, "eval_set")


@query
def value_counts_dow(spark, sf_dir):
    return E.value_counts(tables(spark, sf_dir).orders, "order_dow")


@query
def value_counts_days_since(spark, sf_dir):
    return E.value_counts(tables(spark, sf_dir).orders, "days_since_prior_order")


@query
def value_counts_order_number(spark, sf_dir):
    return E.value_counts(tables(spark, sf_dir).orders, "order_number")


@query
def cart_histogram(spark, sf_dir):
    return E.fixed_bin_histogram(tables(spark, sf_dir).prior_lines, "add_to_cart_order", 30)


@query
def user_max_orders(spark, sf_dir):
    return E.user_max_orders(tables(spark, sf_dir).orders)


@query
def user_max_orders_hist(spark, sf_dir):
    return E.value_counts(E.user_max_orders(tables(spark, sf_dir).orders), "maximum_orders")


@query
def box_stats(spark, sf_dir):
    t = tables(spark, sf_dir)
    return (E.box_stats(t.prior_lines, "add_to_cart_order")
            .unionByName(E.box_stats(t.orders, "days_since_prior_order"))
            .unionByName(E.box_stats(t.orders, "order_number")))


@query
def box_stats_unbounded(spark, sf_dir):
    """E9 on money columns, whose distinct values grow with the rows: quartiles by refined counts."""
    read = lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return (E.box_stats(read("orders"), "o_totalprice", bounded=False)
            .unionByName(E.box_stats(read("lineitem"), "l_extendedprice", bounded=False)))


@query
def corr_pearson(spark, sf_dir):
    return E.corr_pearson(tables(spark, sf_dir).orders, "order_number", "days_since_prior_order")


@query
def corr_spearman(spark, sf_dir):
    return E.corr_spearman(tables(spark, sf_dir).orders, "order_number", "days_since_prior_order")


@query
def dow_hour_contingency(spark, sf_dir):
    return E.contingency(tables(spark, sf_dir).orders, "order_dow", "order_hour_of_day", E.HOURS)


@query
def chi_square(spark, sf_dir):
    return E.chi_square(tables(spark, sf_dir).orders, "order_dow", "order_hour_of_day")


@query
def chi_square_test(spark, sf_dir):
    return E.chi_square_test(tables(spark, sf_dir).orders, "order_dow", "order_hour_of_day")


@query
def chi_square_expected(spark, sf_dir):
    return E.chi_square_expected(tables(spark, sf_dir).orders, "order_dow", "order_hour_of_day")


@query
def dow_hour_counts(spark, sf_dir):
    return (tables(spark, sf_dir).orders.groupBy("order_dow", "order_hour_of_day")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("order_dow", "order_hour_of_day"))


@query
def organic_contingency(spark, sf_dir):
    t = tables(spark, sf_dir)
    return E.pattern_flag_contingency(t.prior_lines, t.products, TEST_ORGANIC_PATTERN)


@query
def organic_reorder_rate(spark, sf_dir):
    t = tables(spark, sf_dir)
    return E.pattern_reorder_rate(t.prior_lines, t.products, TEST_ORGANIC_PATTERN)


@query
def aisle_product_counts(spark, sf_dir):
    t = tables(spark, sf_dir)
    return E.aisle_product_counts(t.products, t.departments, t.aisles)


@query
def dept_reorder_rate(spark, sf_dir):
    t = tables(spark, sf_dir)
    return E.dept_reorder_rate(t.orders, t.prior_lines, t.products, t.departments)


@query
def cart_position_reorder(spark, sf_dir):
    return E.cart_position_reorder(tables(spark, sf_dir).prior_lines)


# ---------------------------------------------------------------- casts, folds
@query
def cast_bulk(spark, sf_dir):
    return _cast_bulk(tables(spark, sf_dir).orders, "double", except_cols=["eval_set"])


@query
def cast_by_type(spark, sf_dir):
    return _cast_by_type(U.user_basket_size(features(spark, sf_dir)[1].order_stats), T.LongType, T.DoubleType())


@query
def fold_assign(spark, sf_dir):
    m = features(spark, sf_dir)[1].train_matrix()
    return ML.assign_folds(m.select("user_id", "product_id", "reordered"))


# ---------------------------------------------------------------- metrics on a deterministic score
def _baseline_scored(spark, sf_dir):
    t, fs = features(spark, sf_dir)
    labelled = M.labelled_candidates(t, M.test_candidates(t))
    return M.reorder_share_score(t, fs.user_product_features(), labelled)


@query
def baseline_scores(spark, sf_dir):
    return _baseline_scored(spark, sf_dir)


@query
def metric_confusion(spark, sf_dir):
    return MT.confusion_counts(_baseline_scored(spark, sf_dir))


@query
def metric_prf(spark, sf_dir):
    return MT.precision_recall_f1(_baseline_scored(spark, sf_dir))


@query
def metric_auc(spark, sf_dir):
    return MT.roc_auc(_baseline_scored(spark, sf_dir))


@query
def metric_logloss(spark, sf_dir):
    return MT.log_loss(_baseline_scored(spark, sf_dir))


# ---------------------------------------------------------------- Spark ML (rows-only checks)
_KEPT: dict[tuple, object] = {}


def _once(spark, sf_dir, name: str, make):
    """A result shared by the queries of one application, as :func:`features` shares the feature tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def _matrices(spark, sf_dir):
    """Train matrix and labelled test matrix as written tables (lineage cut before fitting)."""
    def make():
        t, fs = features(spark, sf_dir)
        labelled = M.labelled_candidates(t, M.test_candidates(t))
        test = M.test_matrix(*fs.feature_tables, fs.orders, labelled, keep=["reordered"])
        return materialize(fs.train_matrix(), "train_matrix"), materialize(test, "test_matrix")

    return _once(spark, sf_dir, "matrices", make)


@query
def train_matrix_holdout(spark, sf_dir):
    """Features from the prior lines only, labels from the train lines (no leakage)."""
    t = tables(spark, sf_dir)
    def make():
        return FeatureSet(t.prior_lines, t.orders.filter("eval_set = 'prior'").drop("eval_set"), t.products,
                          keywords=TEST_KEYWORDS, target_lines=t.train_lines, target_orders=t.orders.filter("eval_set = 'train'"))
    return _once(spark, sf_dir, "holdout", make).train_matrix()


@query
def feature_vector(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    m = features(spark, sf_dir)[1].train_matrix()
    feats = ML.feature_columns(m)
    v = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep").transform(ML.prepare(m, feats))
    rounded = lambda x: F.when(F.rint(x) == x, x + 0.0).otherwise(F.round(x, 9))  # noqa: E731  a whole number (most features are counts) is what it is
    return v.select("user_id", "product_id", "label", F.transform(vector_to_array("features"), rounded).alias("features"))


@query
def train_gbt(spark, sf_dir):
    return ML.train_and_evaluate(*_matrices(spark, sf_dir), ML.PRESETS["gbt"]())


def _validation(train):
    """Rows of four in five users, and of the others."""
    held = F.pmod(F.col("user_id"), F.lit(5)) == 0
    return train.filter(~held), train.filter(held)


def _stopped(spark, sf_dir, preset):
    """Features and a booster stopped by held-out users, trained once per application."""
    def make():
        own, held = _validation(_matrices(spark, sf_dir)[0])
        return BO.fit_boosted(own, ML.feature_columns(own), BO.Params(**preset.params), evaluation=held)

    model = _once(spark, sf_dir, f"booster {preset}", make)
    return model.features, model


def _boosted(spark, sf_dir, preset):
    """One row: rounds run, trees that count and the metrics on the test matrix, stopped by held-out users."""
    feats, model = _stopped(spark, sf_dir, preset)
    return ML.evaluate(ML.score(model, _matrices(spark, sf_dir)[1], feats)).select(
        F.lit(preset.algorithm).alias("algorithm"), F.lit(len(model.losses)).alias("rounds"), F.lit(len(model.used)).alias("trees_used"), "*")


BOOSTER = ML.boosted_preset("boosted", {"rounds": 500, "early_stopping_rounds": 30}, ML.BOOSTER_NAMES)  # the trainer's own rounds and patience


@query
def train_gbt_reference_params(spark, sf_dir):
    """M2: the reference's final parameters with all of its rounds, penalties included."""
    train, test = _matrices(spark, sf_dir)
    feats = ML.feature_columns(train)
    preset = ML.booster_preset(params={"early_stopping_rounds": 0})
    model = BO.fit_boosted(train, feats, BO.Params(**preset.params))
    return ML.evaluate(ML.score(model, test, feats)).select(
        F.lit("boosted").alias("algorithm"), F.lit(len(model.losses)).alias("rounds"), F.lit(len(model.used)).alias("trees_used"), "*")


@query
def train_gbt_early_stop(spark, sf_dir):
    """M6/M8: up to 500 rounds, ended while training by a user-level validation set with the reference's patience."""
    return _boosted(spark, sf_dir, BOOSTER)


@query
def train_gbt_alt(spark, sf_dir):
    """M4: trees grown leaf by leaf, up to 500 rounds."""
    return _boosted(spark, sf_dir, ML.boosted_preset("leaf_wise", None, ML.LEAF_WISE_NAMES, **ML.LEAF_WISE_DEFAULTS))


@query
def train_parallel_trees(spark, sf_dir):
    """M3: rounds of several sampled trees, up to 500 rounds."""
    params = {"rounds": 500, "early_stopping_rounds": 30, "num_parallel_tree": 4, "subsample": 0.8, "colsample_bytree": 0.5}
    return _boosted(spark, sf_dir, ML.boosted_preset("boosted_forest", params, ML.BOOSTER_NAMES))


@query
def split_gains(spark, sf_dir):
    """M2: gain of every split of the first tree's root under the reference's penalties (eight equal widths a feature)."""
    train, _ = _matrices(spark, sf_dir)
    p = ML.booster_preset(params={"max_bin": 8}).params
    return BO.root_gains(train, ML.feature_columns(train), BO.Params(**{**p, "cuts": "width"}))


@query
def train_continued(spark, sf_dir):
    """M9: training goes on from fold to fold, stopped by the test matrix, with the notebook's rounds and patience."""
    train, test = _matrices(spark, sf_dir)
    return ML.continued(train, test, BO.Params(rounds=1000, patience=50, max_depth=4))[1]


@query
def load_predict(spark, sf_dir):
    """The trained booster saved, loaded and used on the test matrix: keys, label, and whether the scores agree."""
    _, model = _stopped(spark, sf_dir, BOOSTER)
    path = scratch_path(spark, f"booster_{uuid.uuid4().hex[:12]}")
    BO.save(spark, model, path)
    rows = _matrices(spark, sf_dir)[1].withColumn("label", F.col("reordered").cast("int"))
    before = BO.predict(model, rows, ["user_id", "product_id", "label"])
    after = BO.predict(BO.load(spark, path), rows, ["user_id", "product_id", "label"])
    return (after.join(before.select(F.struct("user_id", "product_id").alias("of"), F.col("score").alias("score_before")),
                       F.struct("user_id", "product_id") == F.col("of"))
            .select("user_id", "product_id", "label", (F.col("score") == F.col("score_before")).alias("same_score")))


@query
def train_rf(spark, sf_dir):
    return ML.train_and_evaluate(*_matrices(spark, sf_dir), ML.PRESETS["rf"]())


@query
def train_glm(spark, sf_dir):
    return ML.train_and_evaluate(*_matrices(spark, sf_dir), ML.PRESETS["glm"]())


@query
def glm_path(spark, sf_dir):
    """Elastic-net logistic regression along a path of penalties, one row per penalty."""
    train, _ = _matrices(spark, sf_dir)
    path = _once(spark, sf_dir, "glm path", lambda: GLM.fit_path(train, ML.feature_columns(train)))
    return GLM.history(spark, path)


@query
def cv_folds(spark, sf_dir):
    train, _ = _matrices(spark, sf_dir)
    return ML.cross_validate(train, ML.PRESETS["gbt"](10), folds=3)


def _fitted(spark, sf_dir, kind):
    """Train matrix, features and the model of a preset, fitted once per application."""
    train, _ = _matrices(spark, sf_dir)
    feats = ML.feature_columns(train)
    return train, feats, _once(spark, sf_dir, f"model {kind}", lambda: ML.fit(train, ML.PRESETS[kind](), feats))


@query
def score(spark, sf_dir):
    feats, model = _stopped(spark, sf_dir, BOOSTER)
    return ML.score(model, _matrices(spark, sf_dir)[1], feats)


@query
def score_keys(spark, sf_dir):
    """What of the scored rows doesn't depend on the model: keys and labels."""
    return score(spark, sf_dir).select("user_id", "product_id", "label")


@query
def fold_sizes(spark, sf_dir):
    """Rows and users of each cross-validation fold."""
    return (ML.assign_folds(_matrices(spark, sf_dir)[0], 3).groupBy("fold")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users")))


@query
def feature_importance(spark, sf_dir):
    feats, model = _stopped(spark, sf_dir, BOOSTER)
    return ML.feature_importance(spark, model, feats)


@query
def unused_features(spark, sf_dir):
    feats, model = _stopped(spark, sf_dir, BOOSTER)
    return ML.unused_features(spark, ML.feature_importance(spark, model, feats), feats)


@query
def loss_history(spark, sf_dir):
    feats, model = _stopped(spark, sf_dir, BOOSTER)
    return ML.loss_history(spark, model, _matrices(spark, sf_dir)[0], feats)


@query
def loss_history_glm(spark, sf_dir):
    train, feats, model = _fitted(spark, sf_dir, "glm")
    return ML.loss_history(spark, model, train, feats)


@query
def run_log(spark, sf_dir):
    train, test = _matrices(spark, sf_dir)
    feats = ML.feature_columns(train)
    preset = ML.PRESETS["glm"]()
    model, secs = ML.timed_fit(train, preset, feats)
    metrics = ML.evaluate(ML.score(model, test, feats))
    return ML.log_run(spark, scratch_path(spark, "runs"), preset, metrics, secs,
                      dataset_version="1.2", model_version="1.1.1", experiment="basket")


# ---------------------------------------------------------------- sinks
@query
def sink_roundtrip(spark, sf_dir):
    """Write the user features as Parquet below the checkpoint folder and read them back."""
    from basketlab.sources.sinks import write_table
    path = write_table(features(spark, sf_dir)[1].user_features(), scratch_path(spark, f"user_features_{uuid.uuid4().hex[:12]}"))
    return spark.read.parquet(path)


@query
def infer_schema(spark, sf_dir):
    """The orders written as a header-CSV file, their types inferred from all rows."""
    from basketlab.sources.infer import infer_types
    path = scratch_path(spark, f"orders_csv_{uuid.uuid4().hex[:12]}")
    tables(spark, sf_dir).orders.select("order_id", "user_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order",
                                        "eval_set").write.option("header", True).csv(path)
    return infer_types(spark, path)


@query
def csv_roundtrip(spark, sf_dir):
    """Header-less CSV + schema manifest, read back with the manifest's types."""
    from basketlab.sources.csv import read_matrix
    from basketlab.sources.sinks import write_table
    path = write_table(features(spark, sf_dir)[1].time_features(), scratch_path(spark, f"time_features_{uuid.uuid4().hex[:12]}"), "csv")
    return read_matrix(spark, path, "csv")
