"""DuckDB oracle SQL for sources, features and matrices.

Counts are cast to BIGINT and flags to INTEGER so both engines agree on
types; the feature tables cast counts to DOUBLE like the library does.
"""

from oracles.prelude import q

KW = ("red", "cold", "widget")  # same test keywords as the registry
KW_SQL = " OR ".join(f"lower(p.product_name) LIKE '%{k}%'" for k in KW)
DOWS = range(7)

# Feature CTEs, appended after the prelude (each starts with a comma).
CTE_USER = f"""
, u_ord AS (
  SELECT b.user_id, b.order_id, count(b.reordered) AS n_reord, count(b.product_id) AS n_prod,
         coalesce(bool_or({KW_SQL}), false) AS kw,
         coalesce(bool_or(b.reordered = 1), false) AS any_re
  FROM b_base b LEFT JOIN b_products p USING (product_id)
  GROUP BY b.user_id, b.order_id
),
f_user AS (
  SELECT user_id,
         CAST(sum(n_reord) AS DOUBLE) AS frequency_of_reorder,
         CAST(sum(CAST(kw AS INTEGER)) AS DOUBLE) AS count_of_asian_org_items,
         avg(CAST(kw AS INTEGER)) AS mean_of_asian_org_items,
         CAST(max(n_prod) AS DOUBLE) AS max_count_of_products,
         CAST(min(n_prod) AS DOUBLE) AS min_count_of_products,
         avg(n_prod) AS mean_count_of_products,
         CAST(sum(CASE WHEN any_re THEN 0 ELSE 1 END) AS DOUBLE) AS count_ord_no_prev_purchased_items,
         avg(CASE WHEN any_re THEN 0 ELSE 1 END) AS mean_ord_no_prev_purchased_items
  FROM u_ord GROUP BY user_id
)
"""

CTE_STREAK = """
, s_up AS (SELECT DISTINCT user_id, product_id, order_id, order_number FROM b_base),
s_flag AS (
  SELECT *, lead(order_number) OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS next_order_number,
         CASE WHEN lead(order_number) OVER (PARTITION BY user_id, product_id ORDER BY order_number)
                   - order_number = 1 THEN 1 ELSE 0 END AS is_streak_continued_flag
  FROM s_up
),
s_len AS (
  SELECT user_id, product_id, grp, count(order_number) AS length_of_streaks FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number)
           - row_number() OVER (PARTITION BY user_id, product_id, is_streak_continued_flag ORDER BY order_number)
           AS INTEGER) AS grp
    FROM s_flag) GROUP BY user_id, product_id, grp
),
s_isl AS (
  SELECT user_id, product_id, grp, count(order_number) AS length_of_streaks FROM (
    SELECT *, CAST(order_number - row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number)
           AS INTEGER) AS grp
    FROM s_up) GROUP BY user_id, product_id, grp
)
"""


def streak_stats_sql(src: str) -> str:
    return f"""
  SELECT product_id,
         count(grp) AS Total_streak_of_this_product,
         avg(length_of_streaks) AS mean_of_streaks_of_this_product,
         min(length_of_streaks) AS min_of_streaks_of_this_product,
         max(length_of_streaks) AS max_of_streaks_of_this_product,
         sum(CASE WHEN length_of_streaks >= 5 THEN 1 ELSE 0 END) / count(length_of_streaks) AS prob_of_reordered_5,
         sum(CASE WHEN length_of_streaks >= 3 THEN 1 ELSE 0 END) / count(length_of_streaks) AS prob_of_reordered_3,
         sum(CASE WHEN length_of_streaks >= 2 THEN 1 ELSE 0 END) / count(length_of_streaks) AS prob_of_reordered_2
  FROM {src} GROUP BY product_id"""


DOW_SUMS = ",\n".join(
    f"CAST(sum(CAST(order_dow = {k} AS INTEGER)) AS BIGINT) AS distrib_count_of_dow_{k}_p_prod" for k in DOWS)

CTE_CO = """
, p_co AS (
  SELECT a.product_id, a.order_id, count(b.order_id) AS c
  FROM b_hist_lines a LEFT JOIN b_hist_lines b ON a.order_id = b.order_id AND a.product_id <> b.product_id
  GROUP BY a.product_id, a.order_id
)
"""

CTE_PROD = CTE_CO + CTE_STREAK + f"""
, p_one AS (
  SELECT product_id, CAST(sum(f) AS BIGINT) AS number_of_user_purchased_item FROM (
    SELECT l.product_id, o.user_id, max(CASE WHEN sz.n = 1 THEN 1 ELSE 0 END) AS f
    FROM b_hist_lines l JOIN (SELECT order_id, count(product_id) AS n FROM b_hist_lines GROUP BY order_id) sz
      USING (order_id) LEFT JOIN b_hist_orders o USING (order_id)
    WHERE l.product_id IS NOT NULL GROUP BY l.product_id, o.user_id) GROUP BY product_id
),
p_costat AS (
  SELECT product_id, CAST(sum(c) AS BIGINT) AS number_of_product_co_occurred,
         avg(c) AS mean_of_co_ocuured_product_per_order,
         CAST(min(c) AS BIGINT) AS min_of_co_ocuured_product_per_order,
         CAST(max(c) AS BIGINT) AS max_of_co_ocuured_product_per_order
  FROM p_co GROUP BY product_id
),
p_dow AS (SELECT product_id, {DOW_SUMS} FROM b_base GROUP BY product_id),
p_share AS (
  SELECT l.product_id, count(o.order_id) / (SELECT count(DISTINCT order_id) FROM b_hist_orders) AS prob_of_being_reordered
  FROM b_hist_orders o LEFT JOIN b_hist_lines l USING (order_id) GROUP BY l.product_id
),
p_streak AS ({streak_stats_sql("s_len")}),
f_prod AS (
  SELECT a.product_id, a.product_mean_of_position,
         CAST(one.number_of_user_purchased_item AS DOUBLE) AS number_of_user_purchased_item,
         CAST(cs.number_of_product_co_occurred AS DOUBLE) AS number_of_product_co_occurred,
         cs.mean_of_co_ocuured_product_per_order,
         CAST(cs.min_of_co_ocuured_product_per_order AS DOUBLE) AS min_of_co_ocuured_product_per_order,
         CAST(cs.max_of_co_ocuured_product_per_order AS DOUBLE) AS max_of_co_ocuured_product_per_order,
         CAST(st.Total_streak_of_this_product AS DOUBLE) AS Total_streak_of_this_product,
         st.mean_of_streaks_of_this_product,
         CAST(st.min_of_streaks_of_this_product AS DOUBLE) AS min_of_streaks_of_this_product,
         CAST(st.max_of_streaks_of_this_product AS DOUBLE) AS max_of_streaks_of_this_product,
         st.prob_of_reordered_5, st.prob_of_reordered_3, st.prob_of_reordered_2,
         {", ".join(f"CAST(d.distrib_count_of_dow_{k}_p_prod AS DOUBLE) AS distrib_count_of_dow_{k}_p_prod" for k in DOWS)},
         sh.prob_of_being_reordered
  FROM (SELECT product_id, avg(add_to_cart_order) AS product_mean_of_position FROM b_hist_lines GROUP BY product_id) a
  LEFT JOIN p_one one USING (product_id)
  LEFT JOIN p_costat cs USING (product_id)
  LEFT JOIN p_streak st USING (product_id)
  LEFT JOIN p_dow d USING (product_id)
  LEFT JOIN p_share sh USING (product_id)
)
"""

CTE_UP = CTE_CO + """
, f_up AS (
  SELECT x.user_id, x.product_id,
         CAST(x.n AS DOUBLE) AS num_of_ord_purch_p_prod, x.pos AS prod_mean_of_position_p_user,
         CAST(y.c AS DOUBLE) AS num_of_prod_co_ocrd_p_usr_p_prod
  FROM (SELECT user_id, product_id, count(order_id) AS n, avg(add_to_cart_order) AS pos
        FROM b_base GROUP BY user_id, product_id) x
  LEFT JOIN (SELECT o.user_id, c.product_id, sum(c.c) AS c
             FROM p_co c LEFT JOIN b_hist_orders o USING (order_id) GROUP BY o.user_id, c.product_id) y
    ON x.user_id IS NOT DISTINCT FROM y.user_id AND x.product_id IS NOT DISTINCT FROM y.product_id
)
"""

CTE_TIME = """
, t_dow AS (SELECT order_dow, count(order_id) AS total_ord_count_p_dow FROM b_hist_orders GROUP BY order_dow),
t_hour AS (SELECT order_hour_of_day, count(order_id) AS total_ord_count_p_ohod FROM b_hist_orders GROUP BY order_hour_of_day),
f_time AS (
  SELECT o.user_id, o.order_id, o.order_dow AS dow, o.order_hour_of_day AS hour_of_day,
         CAST(d.total_ord_count_p_dow AS DOUBLE) AS total_ord_count_p_dow,
         CAST(h.total_ord_count_p_ohod AS DOUBLE) AS total_ord_count_p_ohod
  FROM b_hist_orders o LEFT JOIN t_dow d USING (order_dow) LEFT JOIN t_hour h USING (order_hour_of_day)
),
t_means AS (
  SELECT (SELECT avg(total_ord_count_p_dow) FROM t_dow) AS time_mean_dow_count,
         (SELECT avg(total_ord_count_p_ohod) FROM t_hour) AS time_mean_ohod_count
)
"""

CTE_CAND = """
, c_cand AS (
  SELECT DISTINCT t.user_id, l.product_id
  FROM b_test_orders t LEFT JOIN b_hist_orders h USING (user_id) LEFT JOIN b_prior l ON l.order_id = h.order_id
)
"""

USER_COLS = ("frequency_of_reorder, count_of_asian_org_items, mean_of_asian_org_items, max_count_of_products, "
             "min_count_of_products, mean_count_of_products, count_ord_no_prev_purchased_items, "
             "mean_ord_no_prev_purchased_items")
PROD_COLS = ("product_mean_of_position, number_of_user_purchased_item, number_of_product_co_occurred, "
             "mean_of_co_ocuured_product_per_order, min_of_co_ocuured_product_per_order, "
             "max_of_co_ocuured_product_per_order, Total_streak_of_this_product, mean_of_streaks_of_this_product, "
             "min_of_streaks_of_this_product, max_of_streaks_of_this_product, prob_of_reordered_5, "
             "prob_of_reordered_3, prob_of_reordered_2, "
             + ", ".join(f"distrib_count_of_dow_{k}_p_prod" for k in DOWS) + ", prob_of_being_reordered")
UP_COLS = "num_of_ord_purch_p_prod, prod_mean_of_position_p_user, num_of_prod_co_ocrd_p_usr_p_prod"


def _test_matrix(how: str) -> str:
    join = "LEFT JOIN" if how == "left" else "JOIN"
    time_cols = ("(SELECT time_mean_dow_count FROM t_means) AS total_ord_count_p_dow, "
                 "(SELECT time_mean_ohod_count FROM t_means) AS total_ord_count_p_ohod")
    return q(CTE_USER + CTE_PROD + CTE_UP.replace(CTE_CO, "") + CTE_TIME + CTE_CAND + f"""
SELECT c.user_id, c.product_id, {time_cols}, {USER_COLS}, {PROD_COLS}, {UP_COLS}
FROM c_cand c {join} f_up USING (user_id, product_id) {join} f_user USING (user_id)
  {join} f_prod USING (product_id)
""")


ORACLES = {
    "union_history": q("SELECT * FROM b_hist_lines"),
    "split_history": q("SELECT * FROM b_hist_orders"),
    "split_test": q("SELECT * FROM b_test_orders"),
    "base_lines": q("SELECT order_id, product_id, add_to_cart_order, reordered, user_id, order_number, "
                    "order_dow, order_hour_of_day FROM b_base"),
    # user
    "user_reorder_frequency": q("SELECT user_id, count(reordered) AS frequency_of_reorder FROM b_base GROUP BY user_id"),
    "user_reorder_sum": q("SELECT user_id, CAST(sum(reordered) AS BIGINT) AS reorder_sum FROM b_base GROUP BY user_id"),
    "user_peak_hour_count": q("""
SELECT user_id, max(c) AS maximum_frquency FROM (
  SELECT user_id, order_hour_of_day, count(order_id) AS c FROM b_hist_orders GROUP BY user_id, order_hour_of_day
) GROUP BY user_id"""),
    "user_keyword_orders": q(CTE_USER + """
SELECT user_id, CAST(sum(CAST(kw AS INTEGER)) AS BIGINT) AS count_of_asian_org_items,
       avg(CAST(kw AS INTEGER)) AS mean_of_asian_org_items FROM u_ord GROUP BY user_id"""),
    "user_basket_size": q(CTE_USER + """
SELECT user_id, max(n_prod) AS max_count_of_products, min(n_prod) AS min_count_of_products,
       avg(n_prod) AS mean_count_of_products FROM u_ord GROUP BY user_id"""),
    "user_all_new_orders": q(CTE_USER + """
SELECT user_id, CAST(sum(CASE WHEN any_re THEN 0 ELSE 1 END) AS BIGINT) AS count_ord_no_prev_purchased_items,
       avg(CASE WHEN any_re THEN 0 ELSE 1 END) AS mean_ord_no_prev_purchased_items FROM u_ord GROUP BY user_id"""),
    "user_features": q(CTE_USER + "SELECT * FROM f_user"),
    # product
    "product_purchase_count": q("SELECT product_id, count(order_id) AS product_count FROM b_hist_lines GROUP BY product_id"),
    "product_cart_position": q("SELECT product_id, avg(add_to_cart_order) AS product_mean_of_position "
                               "FROM b_hist_lines GROUP BY product_id"),
    "product_reorder_rate": q("SELECT product_id, avg(reordered) AS reorder_rate FROM b_hist_lines GROUP BY product_id"),
    "product_one_shot_users": q(CTE_PROD + "SELECT * FROM p_one"),
    "product_cooccurrence": q(CTE_CO + "SELECT product_id, CAST(sum(c) AS BIGINT) AS number_of_product_co_occurred "
                                       "FROM p_co GROUP BY product_id"),
    "product_cooc_per_order": q(CTE_PROD + "SELECT product_id, mean_of_co_ocuured_product_per_order, "
                                           "min_of_co_ocuured_product_per_order, max_of_co_ocuured_product_per_order "
                                           "FROM p_costat"),
    "streak_flags": q(CTE_STREAK + "SELECT user_id, product_id, order_id, order_number, next_order_number, "
                                   "is_streak_continued_flag FROM s_flag"),
    "streak_lengths": q(CTE_STREAK + "SELECT * FROM s_len"),
    "streak_islands": q(CTE_STREAK + "SELECT * FROM s_isl"),
    "product_streak_stats": q(CTE_STREAK + ", st AS (" + streak_stats_sql("s_len") + ") SELECT product_id, "
                              "Total_streak_of_this_product, mean_of_streaks_of_this_product, "
                              "min_of_streaks_of_this_product, max_of_streaks_of_this_product FROM st"),
    "product_streak_probs": q(CTE_STREAK + ", st AS (" + streak_stats_sql("s_len") + ") SELECT product_id, "
                              "prob_of_reordered_5, prob_of_reordered_3, prob_of_reordered_2 FROM st"),
    "product_island_stats": q(CTE_STREAK + streak_stats_sql("s_isl")),
    "order_dow_pivot": q("SELECT order_id, " + ", ".join(
        f"CASE WHEN order_dow = {k} THEN 1 ELSE 0 END AS dow_{k}" for k in DOWS) + " FROM b_hist_orders"),
    "product_dow_distribution": q(f"SELECT product_id, {DOW_SUMS} FROM b_base GROUP BY product_id"),
    "prod_order_share": q(CTE_PROD + "SELECT * FROM p_share"),
    "product_features": q(CTE_PROD + "SELECT * FROM f_prod"),
    # user x product
    "up_order_count": q("SELECT user_id, product_id, count(order_id) AS num_of_ord_purch_p_prod "
                        "FROM b_base GROUP BY user_id, product_id"),
    "up_cart_position": q("SELECT user_id, product_id, avg(add_to_cart_order) AS prod_mean_of_position_p_user "
                          "FROM b_base GROUP BY user_id, product_id"),
    "up_cooccurrence": q(CTE_CO + """
SELECT o.user_id, c.product_id, CAST(sum(c.c) AS BIGINT) AS num_of_prod_co_ocrd_p_usr_p_prod
FROM p_co c LEFT JOIN b_hist_orders o USING (order_id) GROUP BY o.user_id, c.product_id"""),
    "user_product_features": q(CTE_UP + "SELECT * FROM f_up"),
    # time
    "orders_per_dow": q(CTE_TIME + "SELECT * FROM t_dow"),
    "orders_per_hour": q(CTE_TIME + "SELECT * FROM t_hour"),
    "time_features": q(CTE_TIME + "SELECT * FROM f_time"),
    "time_means": q(CTE_TIME + "SELECT * FROM t_means"),
    # matrices
    "train_matrix": q(CTE_USER + CTE_PROD + CTE_UP.replace(CTE_CO, "") + CTE_TIME + f"""
SELECT t.user_id, l.product_id, l.reordered, t.total_ord_count_p_dow, t.total_ord_count_p_ohod,
       {USER_COLS}, {PROD_COLS}, {UP_COLS}
FROM b_hist_lines l LEFT JOIN f_time t USING (order_id)
  LEFT JOIN f_user USING (user_id) LEFT JOIN f_prod USING (product_id)
  LEFT JOIN f_up USING (user_id, product_id)
"""),
    "test_candidates": q(CTE_CAND + "SELECT * FROM c_cand"),
    "sink_roundtrip": q(CTE_USER + "SELECT * FROM f_user"),
    "csv_roundtrip": q(CTE_TIME + "SELECT * FROM f_time"),
    "test_matrix": _test_matrix("left"),
    "test_matrix_inner": _test_matrix("inner"),
    "labelled_candidates": q(CTE_CAND + """
, bought AS (SELECT DISTINCT t.user_id, l.product_id FROM b_test_lines l JOIN b_test_orders t USING (order_id))
SELECT c.user_id, c.product_id, CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS reordered
FROM c_cand c LEFT JOIN bought b ON c.user_id = b.user_id AND c.product_id = b.product_id
"""),
}

# features of the prior orders only, labels from the train lines
ORACLES["train_matrix_holdout"] = q(CTE_USER + CTE_PROD + CTE_UP.replace(CTE_CO, "") + f"""
, h_dow AS (SELECT order_dow, CAST(count(order_id) AS DOUBLE) AS total_ord_count_p_dow FROM b_hist_orders GROUP BY 1),
h_hour AS (SELECT order_hour_of_day, CAST(count(order_id) AS DOUBLE) AS total_ord_count_p_ohod FROM b_hist_orders GROUP BY 1)
SELECT t.user_id, l.product_id, l.reordered, total_ord_count_p_dow, total_ord_count_p_ohod, {USER_COLS}, {PROD_COLS}, {UP_COLS}
FROM b_train l LEFT JOIN (SELECT order_id, user_id, order_dow, order_hour_of_day FROM b_orders WHERE eval_set = 'train') t
    USING (order_id)
  LEFT JOIN h_dow USING (order_dow) LEFT JOIN h_hour USING (order_hour_of_day)
  LEFT JOIN f_user USING (user_id) LEFT JOIN f_prod USING (product_id) LEFT JOIN f_up USING (user_id, product_id)
""").replace("SELECT * FROM b_train UNION ALL SELECT * FROM b_prior", "SELECT * FROM b_prior").replace(
    "FROM b_orders WHERE eval_set <> 'test'", "FROM b_orders WHERE eval_set = 'prior'")

MATRIX = CTE_USER + CTE_PROD + CTE_UP.replace(CTE_CO, "") + CTE_TIME + f"""
, m AS (
  SELECT t.user_id, l.product_id, l.reordered, t.total_ord_count_p_dow, t.total_ord_count_p_ohod, {USER_COLS}, {PROD_COLS}, {UP_COLS}
  FROM b_hist_lines l LEFT JOIN f_time t USING (order_id)
    LEFT JOIN f_user USING (user_id) LEFT JOIN f_prod USING (product_id) LEFT JOIN f_up USING (user_id, product_id))
"""

ORACLES["feature_vector"] = q(MATRIX + """
SELECT user_id, product_id, CAST(reordered AS DOUBLE) AS label,
       list_transform([*COLUMNS(m.* EXCLUDE (user_id, product_id, reordered))], lambda x: round(coalesce(CAST(x AS DOUBLE), 0.0), 9)) AS features
FROM m""")

# second-order gains of the first tree's root: gradient 1/2 - label and hessian 1/4 a row, L2 penalty 11, L1 penalty 89,
# children of a hessian sum of 389 or more, eight equal widths a feature
ORACLES["split_gains"] = q(MATRIX + """
, f AS (SELECT reordered, coalesce(CAST(COLUMNS(m.* EXCLUDE (user_id, product_id, reordered)) AS DOUBLE), 0.0) FROM m
        WHERE reordered IS NOT NULL),
x AS (UNPIVOT f ON COLUMNS(* EXCLUDE reordered) INTO NAME feature VALUE v),
ends AS (SELECT feature, min(v) AS lo, max(v) AS hi, sum(0.5 - reordered) AS g, sum(0.25) AS h, count(*) AS n FROM x GROUP BY feature),
cuts AS (SELECT *, CAST(k AS INTEGER) AS bin, lo + (hi - lo) * k / 8 AS threshold FROM ends, range(1, 8) r(k) WHERE lo < hi),
parts AS (SELECT c.feature, c.bin, c.threshold, c.g, c.h, c.n,
                 coalesce(sum(0.5 - x.reordered) FILTER (WHERE x.v < c.threshold), 0.0) AS left_g,
                 coalesce(sum(0.25) FILTER (WHERE x.v < c.threshold), 0.0) AS left_h,
                 count(*) FILTER (WHERE x.v < c.threshold) AS left_rows
          FROM cuts c JOIN x ON x.feature = c.feature GROUP BY ALL)
SELECT feature, bin, threshold, CAST(left_g AS DOUBLE) AS left_g, CAST(left_h AS DOUBLE) AS left_h, left_rows,
       CASE WHEN least(left_h, h - left_h) >= 389 AND least(left_rows, n - left_rows) >= 1 THEN round(
         greatest(abs(left_g) - 89, 0) ** 2 / (left_h + 11) + greatest(abs(g - left_g) - 89, 0) ** 2 / (h - left_h + 11)
         - greatest(abs(g) - 89, 0) ** 2 / (h + 11), 6) END AS gain
FROM parts""")

ORACLES["base_lines_skewed"] = ORACLES["base_lines"]
