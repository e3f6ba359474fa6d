"""DuckDB oracle SQL for casts, folds and the metric operators."""

from oracles.features_sql import CTE_CAND, CTE_TIME, CTE_USER
from oracles.prelude import q

ORDERS = ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
          "days_since_prior_order"]

SCORED = CTE_CAND + """
, bought AS (SELECT DISTINCT t.user_id, l.product_id FROM b_test_lines l JOIN b_test_orders t USING (order_id)),
x1 AS (SELECT user_id, product_id, count(order_id) AS n FROM b_base GROUP BY user_id, product_id),
nord AS (SELECT user_id, count(*) AS n FROM b_hist_orders GROUP BY user_id),
scored AS (
  SELECT c.user_id, c.product_id, CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS label,
         coalesce(CAST(x1.n AS DOUBLE) / nord.n, 0.0) AS score
  FROM c_cand c
  LEFT JOIN bought b ON c.user_id = b.user_id AND c.product_id = b.product_id
  LEFT JOIN x1 ON c.user_id = x1.user_id AND c.product_id = x1.product_id
  LEFT JOIN nord ON c.user_id = nord.user_id
),
cnt AS (
  SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
         count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
         count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn
  FROM scored
)
"""

ORACLES = {
    "cast_bulk": q("SELECT " + ", ".join(c if c == "eval_set" else f"CAST({c} AS DOUBLE) AS {c}" for c in ORDERS)
                   + " FROM b_orders"),
    "cast_by_type": q(CTE_USER + """
SELECT user_id, CAST(max(n_prod) AS DOUBLE) AS max_count_of_products, CAST(min(n_prod) AS DOUBLE) AS min_count_of_products,
       avg(n_prod) AS mean_count_of_products FROM u_ord GROUP BY user_id"""),
    "fold_assign": q(CTE_TIME + """
SELECT t.user_id, l.product_id, l.reordered, CAST(t.user_id % 3 AS INTEGER) AS fold
FROM b_hist_lines l LEFT JOIN f_time t USING (order_id)"""),
    "fold_sizes": q(CTE_TIME + """
SELECT CAST(t.user_id % 3 AS INTEGER) AS fold, count(*) AS rows, count(DISTINCT t.user_id) AS users
FROM b_hist_lines l LEFT JOIN f_time t USING (order_id) GROUP BY 1"""),
    "score_keys": q(CTE_CAND + """
, bought AS (SELECT DISTINCT t.user_id, l.product_id FROM b_test_lines l JOIN b_test_orders t USING (order_id))
SELECT c.user_id, c.product_id, CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS label
FROM c_cand c LEFT JOIN bought b ON c.user_id = b.user_id AND c.product_id = b.product_id"""),
    "load_predict": q(CTE_CAND + """
, bought AS (SELECT DISTINCT t.user_id, l.product_id FROM b_test_lines l JOIN b_test_orders t USING (order_id))
SELECT c.user_id, c.product_id, CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS label, TRUE AS same_score
FROM c_cand c LEFT JOIN bought b ON c.user_id = b.user_id AND c.product_id = b.product_id"""),
    "baseline_scores": q(SCORED + "SELECT * FROM scored"),
    "metric_confusion": q(SCORED + """
SELECT CASE WHEN score >= 0.5 AND label = 1 THEN 'tp' WHEN score >= 0.5 AND label = 0 THEN 'fp'
            WHEN score < 0.5 AND label = 0 THEN 'tn' ELSE 'fn' END AS confusion_cell, count(*) AS n
FROM scored GROUP BY 1"""),
    "metric_prf": q(SCORED + """
SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
       CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM cnt"""),
    "metric_auc": q(SCORED + """
, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored)
SELECT round((sum(rk) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
       / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0)), 6) AS auc FROM r"""),
    "metric_logloss": q(SCORED + """
SELECT round(-avg(label * ln(least(greatest(score, 1e-15), 1 - 1e-15))
                  + (1 - label) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))), 6) AS logloss FROM scored"""),
}
