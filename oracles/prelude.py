"""Shared DuckDB CTE prelude: the test-data adapter written in plain SQL.

Every oracle query is ``PRELUDE + <more CTEs / SELECT>``.  The views
``part``, ``orders`` and ``lineitem`` are the driver's pre-registered
TPC-H-like tables; all derived names carry a ``b_`` prefix so they never
shadow them.
"""

PRELUDE = """
WITH
b_names AS (
  SELECT min(p_partkey) AS product_id, p_name AS product_name,
         split_part(p_name, ' ', 1) AS aisle,
         substr(p_name, instr(p_name, ' ') + 1) AS department
  FROM part GROUP BY p_name
),
b_aisles AS (SELECT CAST(min(product_id) AS INTEGER) AS aisle_id, aisle FROM b_names GROUP BY aisle),
b_departments AS (SELECT CAST(min(product_id) AS INTEGER) AS department_id, department FROM b_names GROUP BY department),
b_products AS (
  SELECT n.product_id, n.product_name, a.aisle_id, d.department_id
  FROM b_names n JOIN b_aisles a USING (aisle) JOIN b_departments d USING (department)
),
b_orders0 AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS od,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
         lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_od,
         count(*) OVER (PARTITION BY o_custkey) AS n_user
  FROM orders
),
b_orders AS (
  SELECT order_id, user_id,
         CASE WHEN rn = n_user THEN (CASE WHEN user_id % 3 = 0 THEN 'test' ELSE 'train' END)
              ELSE 'prior' END AS eval_set,
         CAST(rn AS INTEGER) AS order_number,
         CAST(dayofweek(od) AS INTEGER) AS order_dow,
         CAST((order_id * 7 + user_id) % 24 AS INTEGER) AS order_hour_of_day,
         CAST(date_diff('day', CAST(prev_od AS DATE), CAST(od AS DATE)) % 31 AS INTEGER) AS days_since_prior_order
  FROM b_orders0
),
b_lines0 AS (
  SELECT l.l_orderkey AS order_id, n.product_id, min(l.l_linenumber) AS ln
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN b_names n ON p.p_name = n.product_name
  GROUP BY l.l_orderkey, n.product_id
),
b_all_lines AS (
  SELECT x.order_id, x.product_id,
         CAST(row_number() OVER (PARTITION BY x.order_id ORDER BY x.ln, x.product_id) AS INTEGER) AS add_to_cart_order,
         CAST(o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, x.product_id) AS INTEGER) AS reordered,
         o.eval_set
  FROM b_lines0 x JOIN b_orders o USING (order_id)
),
b_prior AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_all_lines WHERE eval_set = 'prior'),
b_train AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_all_lines WHERE eval_set = 'train'),
b_test_lines AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_all_lines WHERE eval_set = 'test'),
b_hist_lines AS (SELECT * FROM b_train UNION ALL SELECT * FROM b_prior),
b_hist_orders AS (
  SELECT order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order
  FROM b_orders WHERE eval_set <> 'test'
),
b_test_orders AS (SELECT order_id, user_id FROM b_orders WHERE eval_set = 'test'),
b_base AS (
  SELECT l.order_id, l.product_id, l.add_to_cart_order, l.reordered,
         o.user_id, o.order_number, o.order_dow, o.order_hour_of_day
  FROM b_hist_lines l LEFT JOIN b_hist_orders o USING (order_id)
)
"""


def q(body: str) -> str:
    """Prelude followed by ``body`` (which starts with ``, name AS (...)`` or ``SELECT``)."""
    return PRELUDE + body
