"""DuckDB oracle SQL for the exploratory statistics."""

from oracles.prelude import q

HOURS = range(24)


def _nulls(table: str, view: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM {view}" for c in cols)


LINES = ["order_id", "product_id", "add_to_cart_order", "reordered"]
ORDERS = ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
          "days_since_prior_order"]


def _box(view: str, col: str) -> str:
    return f"""
SELECT '{col}' AS column_name, q1, med AS median, q3, q3 - q1 AS iqr,
       CAST((SELECT min({col}) FROM {view} WHERE {col} >= q1 - 1.5 * (q3 - q1)) AS DOUBLE) AS lower_whisker,
       CAST((SELECT max({col}) FROM {view} WHERE {col} <= q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS upper_whisker,
       (SELECT count(*) FROM {view} WHERE {col} < q1 - 1.5 * (q3 - q1) OR {col} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       (SELECT count({col}) FROM {view}) AS n
FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS med, quantile_cont({col}, 0.75) AS q3
      FROM {view} WHERE {col} IS NOT NULL)"""


def _mid(col: str) -> str:
    return (f"rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0")


ORACLES = {
    "null_profile": q(" " + " UNION ALL ".join([
        _nulls("order_products__prior", "b_prior", LINES), _nulls("orders", "b_orders", ORDERS),
        _nulls("order_products__train", "b_train", LINES),
        _nulls("products", "b_products", ["product_id", "product_name", "aisle_id", "department_id"]),
        _nulls("aisles", "b_aisles", ["aisle_id", "aisle"]),
        _nulls("departments", "b_departments", ["department_id", "department"])])),
    "null_after_first": q("SELECT count(*) FILTER (WHERE days_since_prior_order IS NULL) AS null_count "
                          "FROM b_orders WHERE order_number <> 1"),
    "distinct_counts": q("""
SELECT 'order_products__prior' AS table_name, 'reordered' AS column_name,
       count(DISTINCT reordered) + max(CAST(reordered IS NULL AS INTEGER)) AS n_distinct FROM b_prior
UNION ALL SELECT 'order_products__train', 'reordered', count(DISTINCT reordered) + max(CAST(reordered IS NULL AS INTEGER)) FROM b_train
UNION ALL SELECT 'orders', 'eval_set', count(DISTINCT eval_set) + max(CAST(eval_set IS NULL AS INTEGER)) FROM b_orders
UNION ALL SELECT 'test_orders', 'user_id', count(DISTINCT user_id) + max(CAST(user_id IS NULL AS INTEGER)) FROM b_test_orders
"""),
    "distinct_values": q("""
SELECT DISTINCT 'eval_set' AS column_name, eval_set AS value FROM b_orders
UNION ALL SELECT DISTINCT 'order_dow', CAST(order_dow AS VARCHAR) FROM b_orders
UNION ALL SELECT DISTINCT 'order_hour_of_day', CAST(order_hour_of_day AS VARCHAR) FROM b_orders
"""),
    "column_extrema": q("""
SELECT max(days_since_prior_order) AS max_days_since_prior_order, max(order_number) AS max_order_number,
       count(*) AS n_orders, (SELECT count(*) FROM b_test_orders) AS n_test_orders FROM b_orders"""),
    "value_counts_reordered": q("SELECT reordered, count(*) AS count FROM b_prior GROUP BY reordered"),
    "value_counts_eval_set": q("SELECT eval_set, count(*) AS count FROM b_orders GROUP BY eval_set"),
    "value_counts_dow": q("SELECT order_dow, count(*) AS count FROM b_orders GROUP BY order_dow"),
    "value_counts_days_since": q("SELECT days_since_prior_order, count(*) AS count FROM b_orders "
                                 "GROUP BY days_since_prior_order"),
    "value_counts_order_number": q("SELECT order_number, count(*) AS count FROM b_orders GROUP BY order_number"),
    "cart_histogram": q("""
, mm AS (SELECT CAST(min(add_to_cart_order) AS DOUBLE) AS lo, CAST(max(add_to_cart_order) AS DOUBLE) AS hi FROM b_prior),
bb AS (
  SELECT CAST(CASE WHEN (hi - lo) / 30 = 0 THEN 0
                   ELSE least(floor((add_to_cart_order - lo) / ((hi - lo) / 30)), 29) END AS INTEGER) AS bin
  FROM b_prior, mm WHERE add_to_cart_order IS NOT NULL
)
SELECT bin, (SELECT lo FROM mm) + bin * (SELECT (hi - lo) / 30 FROM mm) AS bin_start,
       (SELECT lo FROM mm) + (bin + 1) * (SELECT (hi - lo) / 30 FROM mm) AS bin_end, count(*) AS count
FROM bb GROUP BY bin"""),
    "user_max_orders": q("SELECT user_id, max(order_number) AS maximum_orders FROM b_orders GROUP BY user_id"),
    "user_max_orders_hist": q("SELECT maximum_orders, count(*) AS count FROM "
                              "(SELECT user_id, max(order_number) AS maximum_orders FROM b_orders GROUP BY user_id) "
                              "GROUP BY maximum_orders"),
    "box_stats": q(_box("b_prior", "add_to_cart_order") + " UNION ALL "
                   + _box("b_orders", "days_since_prior_order") + " UNION ALL " + _box("b_orders", "order_number")),
    "corr_pearson": q("SELECT round(corr(CAST(order_number AS DOUBLE), CAST(days_since_prior_order AS DOUBLE)), 6) "
                      "AS pearson FROM b_orders WHERE order_number IS NOT NULL AND days_since_prior_order IS NOT NULL"),
    "corr_spearman": q(f"""
, d AS (SELECT order_number, days_since_prior_order FROM b_orders
        WHERE order_number IS NOT NULL AND days_since_prior_order IS NOT NULL),
r AS (SELECT {_mid("order_number")} AS rx, {_mid("days_since_prior_order")} AS ry FROM d)
SELECT round(corr(rx, ry), 6) AS spearman FROM r"""),
    "dow_hour_contingency": q("SELECT order_dow, " + ", ".join(
        f'count(*) FILTER (WHERE order_hour_of_day = {h}) AS "{h}"' for h in HOURS)
        + " FROM b_orders GROUP BY order_dow"),
    "chi_square": q("""
, cells AS (SELECT order_dow, order_hour_of_day, CAST(count(*) AS DOUBLE) AS o FROM b_orders GROUP BY 1, 2),
rows_ AS (SELECT order_dow, sum(o) AS r FROM cells GROUP BY 1),
cols_ AS (SELECT order_hour_of_day, sum(o) AS c FROM cells GROUP BY 1),
grid AS (
  SELECT r.order_dow, c.order_hour_of_day, coalesce(x.o, 0) AS o, r.r * c.c / (SELECT sum(o) FROM cells) AS e
  FROM rows_ r JOIN cols_ c ON true
  LEFT JOIN cells x ON x.order_dow = r.order_dow AND x.order_hour_of_day = c.order_hour_of_day
)
SELECT round(sum((o - e) * (o - e) / e), 6) AS statistic,
       ((SELECT count(*) FROM rows_) - 1) * ((SELECT count(*) FROM cols_) - 1) AS dof FROM grid"""),
    "chi_square_expected": q("""
, cells AS (SELECT order_dow, order_hour_of_day, count(*) AS o FROM b_orders GROUP BY 1, 2),
rows_ AS (SELECT order_dow, count(*) AS r FROM b_orders GROUP BY 1),
cols_ AS (SELECT order_hour_of_day, count(*) AS c FROM b_orders GROUP BY 1)
SELECT r.order_dow, c.order_hour_of_day, coalesce(x.o, 0) AS observed,
       round(r.r * c.c / (SELECT CAST(count(*) AS DOUBLE) FROM b_orders), 6) AS expected
FROM rows_ r JOIN cols_ c ON true
  LEFT JOIN cells x ON x.order_dow = r.order_dow AND x.order_hour_of_day = c.order_hour_of_day"""),
    "dow_hour_counts": q("SELECT order_dow, order_hour_of_day, count(*) AS count FROM b_orders GROUP BY 1, 2"),
    "organic_contingency": q("""
SELECT regexp_matches(p.product_name, '(?i)red') AS is_organic,
       count(*) FILTER (WHERE l.reordered = 0) AS "0", count(*) FILTER (WHERE l.reordered = 1) AS "1"
FROM b_prior l JOIN b_products p USING (product_id) GROUP BY 1"""),
    "organic_reorder_rate": q("""
, c AS (
  SELECT regexp_matches(p.product_name, '(?i)red') AS f,
         count(*) FILTER (WHERE l.reordered = 0) AS n0, count(*) FILTER (WHERE l.reordered = 1) AS n1
  FROM b_prior l JOIN b_products p USING (product_id) GROUP BY 1)
SELECT CASE WHEN f THEN 'Organic' WHEN NOT f THEN 'Not Organic' END AS product_type,
       n0 AS not_reordered, n1 AS reordered, n0 + n1 AS total, n1 / (n0 + n1) * 100 AS reorder_percentage FROM c"""),
    "aisle_product_counts": q("""
SELECT d.department, a.aisle, count(p.product_id) AS prod_count_p_aisle,
       regexp_replace(a.aisle, ' ', '<br>') AS aisle_with_br
FROM b_products p JOIN b_departments d USING (department_id) JOIN b_aisles a USING (aisle_id)
GROUP BY d.department, a.aisle"""),
    "dept_reorder_rate": q("""
SELECT d.department, count(*) AS total_prod_sold, CAST(coalesce(sum(l.reordered), 0) AS BIGINT) AS reorder_count,
       coalesce(sum(l.reordered), 0) / count(*) * 100 AS reorder_percentage
FROM b_orders o LEFT JOIN b_prior l USING (order_id) LEFT JOIN b_products p USING (product_id)
  LEFT JOIN b_departments d USING (department_id)
WHERE o.eval_set = 'prior' GROUP BY d.department"""),
    "cart_position_reorder": q("""
SELECT CAST(add_to_cart_order AS VARCHAR) AS add_to_cart_order, count(*) AS total_count,
       CAST(sum(reordered) AS BIGINT) AS reorder_count, sum(reordered) / count(*) * 100 AS reorder_cart_ratio
FROM b_prior GROUP BY add_to_cart_order"""),
}

ORACLES["box_stats_unbounded"] = q(_box("orders", "o_totalprice") + " UNION ALL " + _box("lineitem", "l_extendedprice"))

# upper tail of the chi-square distribution with an even number of degrees of freedom (138 here): a finite Poisson sum
ORACLES["chi_square_test"] = ORACLES["chi_square"].replace("SELECT round(sum((o - e)", ", st AS (SELECT round(sum((o - e)") + """)
SELECT statistic, CAST(dof AS BIGINT) AS dof,
       round(list_sum(list_transform(range(0, CAST(dof // 2 AS BIGINT)),
                                     lambda i: exp(-statistic / 2 + i * ln(statistic / 2) - lgamma(i + 1)))), 9) AS p_value FROM st"""


def _typed(position: int, column: str) -> str:
    return f"""
SELECT {position} AS position, '{column}' AS column_name, count(*) AS rows, count(*) - count({column}) AS nulls,
       CAST(0 AS BIGINT) AS n_boolean, count(*) FILTER (WHERE abs({column}) <= 2147483647) AS n_int,
       count(*) FILTER (WHERE abs({column}) > 2147483647) AS n_long, CAST(0 AS BIGINT) AS n_double, CAST(0 AS BIGINT) AS n_date,
       CAST(0 AS BIGINT) AS n_timestamp, CAST(0 AS BIGINT) AS n_string,
       CASE WHEN max(abs({column})) > 2147483647 THEN 'long' ELSE 'int' END AS inferred, CAST(0 AS BIGINT) AS conflicts FROM b_orders"""


ORACLES["infer_schema"] = q(" UNION ALL ".join(_typed(i, c) for i, c in enumerate(
    ["order_id", "user_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"])) + """ UNION ALL
SELECT 6, 'eval_set', count(*), count(*) - count(eval_set), 0, 0, 0, 0, 0, 0, count(eval_set), 'string', 0 FROM b_orders""")
