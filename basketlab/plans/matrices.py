"""Scoring candidates, the test matrix and labelled hold-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from basketlab.operators import product as P
from basketlab.operators import time as TM
from basketlab.operators import user as U
from basketlab.operators import user_product as X
from basketlab.schemas import require_columns
from basketlab.sources.tables import BasketTables

TEST_TIME_COLUMNS = ("time_mean_dow_count", "time_mean_ohod_count")
# The trainer renames the test-set time columns to the train-set names (F8).
TIME_RENAME = dict(zip(TEST_TIME_COLUMNS, TM.TIME_FEATURES))


def test_candidates(t: BasketTables, drop_null_products: bool = False) -> DataFrame:
    """Distinct (user, product) from the prior lines of test users.

    Same result as test users LEFT JOIN their history orders LEFT JOIN *prior*
    lines (a history order without prior lines, e.g. the user's ``train``
    order, yields a (user, NULL) candidate), but the large tables stay on the
    side of each join that adaptive execution can split when one user holds
    a large share of the orders:

    * history orders LEFT SEMI JOIN test users, then LEFT JOIN prior lines;
    * test users without any history order: anti join against the distinct
      history users (pre-aggregated), each giving (user, NULL).
    """
    test_users = t.test_orders().select("user_id")
    hist = t.history_orders().select("user_id", "order_id")
    with_history = (hist.join(test_users, "user_id", "left_semi")
                    .join(t.prior_lines.select("order_id", "product_id"), "order_id", "left")
                    .select("user_id", "product_id"))
    without_history = (test_users.join(hist.select("user_id").distinct(), "user_id", "left_anti")
                       .select("user_id", F.lit(None).cast("long").alias("product_id")))
    c = with_history.unionByName(without_history).distinct()
    return c.filter(F.col("product_id").isNotNull()) if drop_null_products else c


def test_matrix(user_f: DataFrame, product_f: DataFrame, up_f: DataFrame, time_orders: DataFrame,
                candidates: DataFrame, how: str = "left", rename_time: bool = True,
                keep: Sequence[str] = ()) -> DataFrame:
    """A2: candidates + the two scalar time means + user / product / user-product features.

    ``how="inner"`` is the older variant (drops candidates without
    features; the time columns come last).  ``rename_time`` applies the
    trainer's renaming so train and test matrices share column names.
    ``keep`` lists extra candidate columns to carry (e.g. a hold-out label).
    """
    for df, what in ((user_f, "user features"), (up_f, "user-product features")):
        require_columns(df, "user_id", what=what)
    for df, what in ((product_f, "product features"), (up_f, "user-product features")):
        require_columns(df, "product_id", what=what)
    require_columns(candidates, "user_id", "product_id", what="candidates")
    means = TM.time_means(time_orders)
    tm = [means.select(c).scalar().alias(c) for c in TEST_TIME_COLUMNS]
    m = (candidates.select("user_id", "product_id", *keep)
         .join(up_f, ["user_id", "product_id"], how)
         .join(user_f, "user_id", how)
         .join(product_f, "product_id", how))
    feats = [*U.USER_FEATURES, *P.PRODUCT_FEATURES, *X.USER_PRODUCT_FEATURES]
    if how == "inner":
        out = m.select("user_id", "product_id", *keep, *feats, *tm)
    else:
        out = m.select("user_id", "product_id", *keep, *tm, *feats)
    return out.withColumnsRenamed(TIME_RENAME) if rename_time else out


def generate_test_set_features(user_stats: DataFrame, product_stats: DataFrame, user_product_stats: DataFrame,
                               time_stats: DataFrame, test_set: DataFrame) -> DataFrame:
    """A2 under the original pipeline's signature: ``time_stats`` is the
    per-order time-feature table.  Each weekday (hour) carries one count, so
    the corrected means are averages over its distinct (weekday, count)
    pairs.  Columns keep the ``time_mean_*`` names, as that pipeline did.
    """
    require_columns(time_stats, "dow", "hour_of_day", *TM.TIME_FEATURES, what="time features")
    for df, what in ((user_stats, "user features"), (user_product_stats, "user-product features")):
        require_columns(df, "user_id", what=what)
    for df, what in ((product_stats, "product features"), (user_product_stats, "user-product features")):
        require_columns(df, "product_id", what=what)
    require_columns(test_set, "user_id", "product_id", what="test_set")
    dow = time_stats.select("dow", "total_ord_count_p_dow").distinct().agg(F.avg("total_ord_count_p_dow"))
    hour = time_stats.select("hour_of_day", "total_ord_count_p_ohod").distinct().agg(
        F.avg("total_ord_count_p_ohod"))
    feats = [*U.USER_FEATURES, *P.PRODUCT_FEATURES, *X.USER_PRODUCT_FEATURES]
    return (test_set.select("user_id", "product_id")
            .join(user_stats, "user_id", "left").join(product_stats, "product_id", "left")
            .join(user_product_stats, ["user_id", "product_id"], "left")
            .select("user_id", "product_id", dow.scalar().alias("time_mean_dow_count"),
                    hour.scalar().alias("time_mean_ohod_count"), *feats))


def labelled_candidates(t: BasketTables, candidates: DataFrame) -> DataFrame:
    """A4: label each candidate with whether the user bought it in the test order."""
    if t.test_lines is None:
        raise ValueError("labelled candidates need the held-out test order lines")
    bought = (t.test_lines.select("order_id", "product_id")
              .join(t.test_orders(), "order_id")
              .select("user_id", "product_id", F.lit(1).alias("_hit")).distinct())
    return (candidates.join(bought, ["user_id", "product_id"], "left")
            .select("user_id", "product_id", F.coalesce("_hit", F.lit(0)).alias("reordered")))


def reorder_share_score(t: BasketTables, up_f: DataFrame, labelled: DataFrame) -> DataFrame:
    """Deterministic baseline score of a labelled candidate: the share of the
    user's history orders that contained the product (0 without history).

    Used to exercise the metric operators on a score that SQL can reproduce.
    """
    n_orders = t.history_orders().groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    s = (labelled.join(up_f.select("user_id", "product_id", "num_of_ord_purch_p_prod"),
                       ["user_id", "product_id"], "left")
         .join(n_orders, "user_id", "left"))
    return s.select("user_id", "product_id", F.col("reordered").alias("label"),
                    F.coalesce(F.try_divide(F.col("num_of_ord_purch_p_prod"), F.col("_n")), F.lit(0.0))
                    .alias("score"))
