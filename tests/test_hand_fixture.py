"""FIXTURES §3: every feature group on a four-order hand fixture."""

import pytest

from basketlab.operators import product as P
from basketlab.operators import time as TM
from basketlab.operators import user as U
from basketlab.plans.features import FeatureSet
from conftest import make_tables, rows

ORDERS = [  # order_id, user_id, eval_set, order_number, dow, hour, days_since
    (1, 1, "prior", 1, 0, 8, None), (2, 1, "prior", 2, 1, 9, 3),
    (3, 1, "prior", 3, 0, 8, 4), (4, 2, "prior", 1, 0, 8, None),
]
LINES = [(1, 10, 1, 0), (1, 11, 2, 0), (2, 10, 1, 1), (3, 11, 1, 1), (3, 12, 2, 0), (4, 11, 1, 0)]
PRODUCTS = [(10, "Organic Milk", 1, 1), (11, "Plain Bread", 1, 1), (12, "Gluten Free Oats", 1, 1)]


@pytest.fixture(scope="module")
def fs(spark):
    return FeatureSet.from_tables(make_tables(spark, ORDERS, LINES, PRODUCTS))


def approx_rows(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=1e-6)


def test_user_features(fs):
    got = rows(fs.user_features(), "user_id", *U.USER_FEATURES)
    approx_rows(got, [(1, 5, 3, 1.0, 2, 1, 5 / 3, 1, 1 / 3), (2, 1, 0, 0.0, 1, 1, 1.0, 1, 1.0)])


def test_user_peak_hour(fs):
    assert rows(U.user_peak_hour_count(fs.orders), "user_id", "maximum_frquency") == [(1, 2), (2, 1)]


def test_user_reorder_sum_vs_count(fs):
    assert rows(U.user_reorder_sum(fs.base), "user_id", "reorder_sum") == [(1, 2), (2, 0)]
    assert rows(U.user_reorder_frequency(fs.base), "user_id", "frequency_of_reorder") == [(1, 5), (2, 1)]


def test_product_features(fs):
    cols = ["product_id", "product_mean_of_position", "number_of_user_purchased_item",
            "number_of_product_co_occurred", "mean_of_co_ocuured_product_per_order",
            "min_of_co_ocuured_product_per_order", "max_of_co_ocuured_product_per_order",
            "prob_of_being_reordered", "distrib_count_of_dow_0_p_prod", "distrib_count_of_dow_1_p_prod"]
    approx_rows(rows(fs.product_features(), *cols), [
        (10, 1.0, 1, 1, 0.5, 0, 1, 0.50, 1, 1),
        (11, 4 / 3, 1, 2, 2 / 3, 0, 1, 0.75, 3, 0),
        (12, 2.0, 0, 1, 1.0, 1, 1, 0.25, 1, 0),
    ])
    assert rows(P.product_purchase_count(fs.lines), "product_id", "product_count") == [(10, 2), (11, 3), (12, 1)]
    approx_rows(rows(P.product_reorder_rate(fs.lines), "product_id", "reorder_rate"),
                [(10, 0.5), (11, 1 / 3), (12, 0.0)])


@pytest.mark.parametrize("mode,want", [
    ("compat", [(10, 2, 1.0, 1, 1, 0.0), (11, 2, 1.5, 1, 2, 0.5), (12, 1, 1.0, 1, 1, 0.0)]),
    ("island", [(10, 1, 2.0, 2, 2, 1.0), (11, 3, 1.0, 1, 1, 0.0), (12, 1, 1.0, 1, 1, 0.0)]),
])
def test_streak_stats(spark, mode, want):
    fs = FeatureSet.from_tables(make_tables(spark, ORDERS, LINES, PRODUCTS), streak_mode=mode)
    cols = ["product_id", "Total_streak_of_this_product", "mean_of_streaks_of_this_product",
            "min_of_streaks_of_this_product", "max_of_streaks_of_this_product", "prob_of_reordered_2"]
    approx_rows(rows(fs.product_features(), *cols), want)


def test_user_product_features(fs):
    got = rows(fs.user_product_features(), "user_id", "product_id", "num_of_ord_purch_p_prod",
               "prod_mean_of_position_p_user", "num_of_prod_co_ocrd_p_usr_p_prod")
    approx_rows(got, [(1, 10, 2, 1.0, 1), (1, 11, 2, 1.5, 2), (1, 12, 1, 2.0, 1), (2, 11, 1, 1.0, 0)])


def test_time_features(fs):
    assert rows(TM.orders_per_dow(fs.orders), "order_dow", "total_ord_count_p_dow") == [(0, 3), (1, 1)]
    assert rows(TM.orders_per_hour(fs.orders), "order_hour_of_day", "total_ord_count_p_ohod") == [(8, 3), (9, 1)]
    assert rows(fs.time_means(), "time_mean_dow_count", "time_mean_ohod_count") == [(2.0, 2.0)]
    t = rows(fs.time_features(), "order_id", "total_ord_count_p_dow", "total_ord_count_p_ohod")
    assert t == [(1, 3.0, 3.0), (2, 1.0, 1.0), (3, 3.0, 3.0), (4, 3.0, 3.0)]


def test_train_matrix_shape(fs):
    from basketlab.plans.features import TRAIN_MATRIX_COLUMNS
    m = fs.train_matrix()
    assert tuple(m.columns) == TRAIN_MATRIX_COLUMNS
    assert len(m.columns) == 37 and m.count() == len(LINES)
    assert all(dict(m.dtypes)[c] == "double" for c in TRAIN_MATRIX_COLUMNS[3:])


def test_order_dow_pivot(fs):
    got = rows(P.order_dow_pivot(fs.orders), "order_id", "dow_0", "dow_1", "dow_6")
    assert got == [(1, 1, 0, 0), (2, 0, 1, 0), (3, 1, 0, 0), (4, 1, 0, 0)]


def test_train_matrix_with_duplicate_lines(spark):
    """A duplicated (order, product) line keeps one matrix row per line (joined-base spine)."""
    dup = LINES + [(3, 12, 3, 0)]
    fs = FeatureSet.from_tables(make_tables(spark, ORDERS, dup, PRODUCTS))
    m = fs.train_matrix()
    assert m.count() == len(dup)
    assert rows(m.filter("product_id = 12"), "user_id", "reordered") == [(1, 0), (1, 0)]


def test_original_api_names(spark, fs):
    from basketlab.plans import matrices as M
    t = make_tables(spark, ORDERS + [(5, 2, "test", 2, 1, 9, 2)], LINES, PRODUCTS)
    f = FeatureSet.from_tables(t)
    assert rows(f.generate_user_related_features(), "user_id") == [(1,), (2,)]
    assert f.generate_all_types_of_features().count() == len(LINES)
    cand = M.test_candidates(t)
    out = M.generate_test_set_features(f.generate_user_related_features(), f.generate_product_related_features(),
                                       f.generate_user_product_related_features(),
                                       f.generate_time_related_features(), cand)
    new = M.test_matrix(*f.feature_tables, f.orders, cand, rename_time=False)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, new.select(*out.columns).collect()))
    assert rows(out, "time_mean_dow_count", "time_mean_ohod_count")[0] == (2.0, 2.0)


def test_candidates_cover_users_without_history(spark):
    from basketlab.plans import matrices as M
    orders = ORDERS + [(5, 2, "test", 2, 1, 9, 2), (6, 3, "test", 1, 2, 10, None),
                       (7, 1, "train", 4, 3, 11, 1), (8, 1, "test", 5, 3, 11, 1)]
    t = make_tables(spark, orders, LINES, PRODUCTS)
    got = rows(M.test_candidates(t), "user_id", "product_id")
    # user 1: prior products + NULL for its train order (no prior lines); user 2: 11;
    # user 3 has no history order at all
    assert got == [(1, 10), (1, 11), (1, 12), (1, None), (2, 11), (3, None)]
    assert rows(M.test_candidates(t, drop_null_products=True), "user_id", "product_id") == [
        (1, 10), (1, 11), (1, 12), (2, 11)]
