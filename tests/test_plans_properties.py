"""Plan shape assertions and cross-feature properties on sf0.001."""

import pytest
from pyspark.sql import functions as F

from basketlab.operators import product as P
from basketlab.operators import user_product as X
from basketlab.plans import matrices as M
from basketlab.plans.features import FeatureSet
from basketlab.sources.testdata import load_testdata
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def ctx(spark):
    t = load_testdata(spark, SF_SMALL)
    return t, FeatureSet.from_tables(t)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["train_matrix", "product_features", "user_features", "user_product_features"])
def test_no_cartesian_no_python(ctx, name):
    df = getattr(ctx[1], name)()
    p = plan_text(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, bad


def test_scan_prunes_columns(spark):
    p = load_testdata(spark, SF_SMALL).history_lines().select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<order_id:bigint>" in p and "product_id" not in p


def test_streak_probabilities_ordered(ctx):
    pf = ctx[1].product_features()
    bad = pf.filter((F.col("prob_of_reordered_2") < F.col("prob_of_reordered_3"))
                    | (F.col("prob_of_reordered_3") < F.col("prob_of_reordered_5"))
                    | (F.col("min_of_streaks_of_this_product") > F.col("mean_of_streaks_of_this_product"))
                    | (F.col("mean_of_streaks_of_this_product") > F.col("max_of_streaks_of_this_product")))
    assert bad.count() == 0


def test_dow_distribution_sums_to_purchase_count(ctx):
    fs = ctx[1]
    dow = P.product_dow_distribution(fs.base)
    s = dow.select("product_id", sum(F.col(f"distrib_count_of_dow_{k}_p_prod") for k in range(7)).alias("s"))
    j = s.join(P.product_purchase_count(fs.lines), "product_id")
    assert j.filter(F.col("s") != F.col("product_count")).count() == 0


def test_streak_lengths_cover_purchases(ctx):
    fs = ctx[1]
    x1 = X.up_order_count(fs.base).groupBy("product_id").agg(F.sum("num_of_ord_purch_p_prod").alias("n"))
    for mode in ("compat", "island"):
        s = fs.streak_lengths(mode).groupBy("product_id").agg(F.sum("length_of_streaks").alias("s"))
        assert s.join(x1, "product_id").filter(F.col("s") != F.col("n")).count() == 0, mode


def test_matrix_row_counts(ctx):
    t, fs = ctx
    assert fs.train_matrix().count() == t.history_lines().count()
    cand = M.test_candidates(t)
    tm = M.test_matrix(fs.user_features(), fs.product_features(), fs.user_product_features(), fs.orders, cand)
    assert tm.count() == cand.count()
    assert cand.groupBy("user_id", "product_id").count().filter("count > 1").count() == 0


def test_feature_tables_unique_on_keys(ctx):
    fs = ctx[1]
    assert fs.user_features().groupBy("user_id").count().filter("count > 1").count() == 0
    assert fs.product_features().groupBy("product_id").count().filter("count > 1").count() == 0
    assert fs.user_product_features().groupBy("user_id", "product_id").count().filter("count > 1").count() == 0


def test_distinct_counts_approx_small_domains(ctx):
    from basketlab.operators import eda as E
    t = ctx[0]
    cols = [("orders", t.orders, "eval_set"), ("orders", t.orders, "order_dow")]
    exact = sorted(E.distinct_counts(cols).collect())
    approx = sorted(E.distinct_counts(cols, approx=True).collect())
    assert exact == approx


def test_train_matrix_plan_stays_small(ctx):
    """The matrix reads written tables: no raw-table rescans, few exchanges."""
    import re
    p = plan_text(ctx[1].train_matrix())
    assert "lineitem.parquet" not in p and "part.parquet" not in p
    assert len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", p)) <= 8


def test_eval_set_filter_pushed_to_scan(ctx):
    p = ctx[0].test_orders()._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(eval_set), EqualTo(eval_set,test)]" in p


def executed(df, spark, threshold="1"):
    """The plan as it ran, with broadcasting by estimate switched off."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df.write.format("noop").mode("overwrite").save()
        q = df._jdf.queryExecution()
        q.executedPlan().execute().count()
        return q.executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_exchange_on_weekday_or_hour(ctx, spark):
    import re
    for df in (ctx[1].train_matrix(), ctx[1].time_features()):
        p = executed(df, spark)
        joins = [x for x in p.splitlines() if re.search(r"Join", x)]
        assert not any("order_dow" in x or "order_hour" in x for x in joins)


def test_orders_are_joined_once(spark, ctx):
    import re

    from basketlab.operators import base as B
    t = ctx[0]
    kept = []

    def keep(df):
        kept.append(df)
        return spark.createDataFrame(df.collect(), df.schema)

    p = executed(B.order_product_stats(t.prior_lines, t.history_orders(), keep), spark)
    final = p.split("== Initial Plan ==")[0]
    assert len(kept) == 1
    assert len(re.findall(r"FileScan parquet \[order_id", final)) == 1  # the orders
    assert len(re.findall(r"FileScan", executed(kept[0], spark).split("== Initial Plan ==")[0])) == 1  # the lines


def test_prior_lines_read_their_partition_only(ctx):
    p = ctx[0].prior_lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eval_set" in p
