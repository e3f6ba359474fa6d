"""Exploratory statistics (E1-E19) as Spark aggregations.

Each function returns the data behind one chart or printed statistic of the
exploratory analysis: a small aggregated DataFrame, computed on executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from basketlab.functions.prefix import ranked_counts
from basketlab.functions.quantiles import exact_quantiles
from basketlab.functions.special import chi_square_tail
from basketlab.session import materialize

HOURS = tuple(range(24))


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, null_count) for every column of every table."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        parts.append(counts.unpivot([], df.columns, "column_name", "null_count")
                     .select(F.lit(name).alias("table_name"), "column_name", "null_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_after_first(orders: DataFrame) -> DataFrame:
    """NULL ``days_since_prior_order`` among orders that are not a user's first."""
    return (orders.filter(F.col("order_number") != 1)
            .agg(F.count_if(F.col("days_since_prior_order").isNull()).alias("null_count")))


def distinct_counts(columns: Sequence[tuple[str, DataFrame, str]], approx: bool = False) -> DataFrame:
    """(table_name, column_name, n_distinct); NULL counts as one value.

    ``approx=True`` uses the fixed-memory HyperLogLog++ sketch
    (``approx_count_distinct``) instead of an exact distinct aggregation.
    """
    def nd(c):
        return F.approx_count_distinct(c) if approx else F.count_distinct(c)

    parts = [df.agg((nd(c) + F.max(F.col(c).isNull().cast("int"))).alias("n_distinct"))
             .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "n_distinct")
             for t, df, c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value) for the distinct values of each column (as text)."""
    parts = [df.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")).distinct()
             for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency table of one column (NULL is its own value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def fixed_bin_histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins between min and max; the max falls in the last bin.

    min / max are scalar subqueries, so the whole histogram is one lazy plan.
    """
    x = F.col(col).cast("double")
    lo = df.select(F.min(x)).scalar()
    hi = df.select(F.max(x)).scalar()
    width = (hi - lo) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    return (df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"), "count"))


def user_max_orders(orders: DataFrame) -> DataFrame:
    """Each user's largest order number, ascending."""
    return (orders.groupBy("user_id").agg(F.max("order_number").alias("maximum_orders"))
            .orderBy("maximum_orders", "user_id"))


def box_stats(df: DataFrame, col: str, exact: bool = True, bounded: bool = True) -> DataFrame:
    """Box-plot numbers of one column, NULLs dropped.

    Exact linear-interpolation quartiles, whiskers at the most extreme values
    within 1.5 IQR of the box, outlier count.  For a ``bounded`` domain one
    aggregate keeps a counter per distinct value (``percentile``); otherwise
    the quartiles are selected by refining counts in bounded state
    (``functions/quantiles.py``), in four passes over the rows.  ``exact=False`` uses the
    fixed-size ``percentile_approx`` sketch.
    """
    x, at = F.col(col), [0.25, 0.5, 0.75]
    if exact and not bounded:
        q1, med, q3 = (F.lit(v).cast("double") for v in exact_quantiles(df, col, at) or [None] * 3)
    else:
        q = F.percentile(x, at) if exact else F.percentile_approx(x.cast("double"), at, 10000)
        quart = df.select(q.cast("array<double>").alias("q"))
        q1, med, q3 = (quart.select(F.col("q")[i]).scalar() for i in range(3))
    iqr = q3 - q1
    lo_f, hi_f = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    return df.filter(x.isNotNull()).agg(
        F.lit(col).alias("column_name"),
        q1.alias("q1"), med.alias("median"), q3.alias("q3"), iqr.alias("iqr"),
        F.min(F.when(x >= lo_f, x)).cast("double").alias("lower_whisker"),
        F.max(F.when(x <= hi_f, x)).cast("double").alias("upper_whisker"),
        F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers"),
        F.count(x).alias("n"),
    )


def corr_pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation over rows where both are non-null."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return d.agg(F.round(F.corr(F.col(x).cast("double"), F.col(y).cast("double")), 6).alias("pearson"))


def corr_spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman correlation = Pearson correlation of mid-ranks (ties averaged).

    The rows are counted per (x, y) first; ranks are attached to those cells
    and the correlation is weighted with the counts, so no row is joined.
    """
    cells = materialize(df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
                        .groupBy(F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_w")),
                        "spearman_cells")

    def ranks(col: str):
        counts = cells.groupBy(F.col(col).alias(f"{col}v")).agg(F.sum("_w").alias("_n"))
        return ranked_counts(counts, f"{col}v", "_n", f"{col}r").drop("_n")

    r = cells.join(ranks("_x"), F.col("_x") == F.col("_xv")).join(ranks("_y"), F.col("_y") == F.col("_yv"))
    w, a, b = F.col("_w"), F.col("_xr"), F.col("_yr")
    m = r.agg(F.sum(w).cast("double").alias("n"), F.sum(w * a).alias("a"), F.sum(w * b).alias("b"),
              F.sum(w * a * a).alias("aa"), F.sum(w * b * b).alias("bb"), F.sum(w * a * b).alias("ab"))
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    spread = F.sqrt((n * F.col("aa") - a * a) * (n * F.col("bb") - b * b))
    return m.select(F.round((n * F.col("ab") - a * b) / F.nullif(spread, F.lit(0.0)), 6).alias("spearman"))


def contingency(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Counts of ``row`` x ``col`` with one column per listed ``col`` value, zeros filled.

    The pivot values are given, so no job runs at plan time.
    """
    return df.groupBy(row).pivot(col, list(values)).count().na.fill(0)


def chi_square(df: DataFrame, row: str, col: str) -> DataFrame:
    """Chi-square statistic and degrees of freedom of the row x col table.

    statistic = sum over observed cells of O^2 * N / (R * C) - N, which equals
    sum over all cells of (O - E)^2 / E (empty cells contribute E, folded in).
    """
    cells = df.groupBy(row, col).agg(F.count(F.lit(1)).cast("double").alias("_o"))
    rows = cells.groupBy(row).agg(F.sum("_o").alias("_r"))
    cols = cells.groupBy(col).agg(F.sum("_o").alias("_c"))
    n = cells.select(F.sum("_o")).scalar()
    n_rows = rows.select(F.count(F.lit(1))).scalar()
    n_cols = cols.select(F.count(F.lit(1))).scalar()
    return (cells.join(rows, row).join(cols, col)
            .agg(F.round(F.sum(F.col("_o") * F.col("_o") * n / (F.col("_r") * F.col("_c"))) - n, 6)
                 .alias("statistic"))
            .select("statistic", ((n_rows - 1) * (n_cols - 1)).alias("dof")))


def chi_square_expected(df: DataFrame, row: str, col: str) -> DataFrame:
    """Observed and expected count of every (row, col) cell, empty cells included."""
    cells = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("observed"))
    rows = cells.groupBy(row).agg(F.sum("observed").alias("r"))
    cols = cells.groupBy(col).agg(F.sum("observed").alias("c"))
    n = cells.select(F.sum("observed").cast("double")).scalar()
    every = cols.agg(F.collect_list(F.struct(col, "c"))).scalar()  # the columns of the printed table
    return (rows.select(row, "r", F.inline(every)).join(cells, [row, col], "left")
            .select(row, col, F.coalesce("observed", F.lit(0)).alias("observed"),
                    F.round(F.col("r") * F.col("c") / n, 6).alias("expected")))


def chi_square_test(df: DataFrame, row: str, col: str) -> DataFrame:
    """E13 with p-value: the upper tail of the chi-square distribution as a column expression.

    Any number of row and column values; no vector per row as Spark ML's test needs.
    """
    return chi_square(df, row, col).select("statistic", F.col("dof").cast("long").alias("dof"),
                                           F.round(chi_square_tail(F.col("statistic"), F.col("dof")), 9).alias("p_value"))


def pattern_flag_contingency(lines: DataFrame, products: DataFrame, pattern: str) -> DataFrame:
    """(is_organic, "0", "1"): lines by name-pattern flag x reordered.

    Inner join with products, case-insensitive regex on the product name.
    """
    j = lines.select("product_id", "reordered").join(products.select("product_id", "product_name"), "product_id")
    return (j.withColumn("is_organic", F.col("product_name").rlike(pattern))
            .groupBy("is_organic").pivot("reordered", [0, 1]).count().na.fill(0))


def pattern_reorder_rate(lines: DataFrame, products: DataFrame, pattern: str) -> DataFrame:
    """Row totals and reorder percentage per flag, labelled 'Organic' / 'Not Organic'."""
    c = pattern_flag_contingency(lines, products, pattern)
    total = F.col("0") + F.col("1")
    return c.select(
        F.when(F.col("is_organic"), F.lit("Organic")).when(~F.col("is_organic"), F.lit("Not Organic"))
        .alias("product_type"),
        F.col("0").alias("not_reordered"), F.col("1").alias("reordered"), total.alias("total"),
        (F.col("1") / total * 100).alias("reorder_percentage"))


def aisle_product_counts(products: DataFrame, departments: DataFrame, aisles: DataFrame) -> DataFrame:
    """Products per (department, aisle); the aisle label gets its first space as ``<br>``."""
    j = products.join(departments, "department_id").join(aisles, "aisle_id")
    return (j.groupBy("department", "aisle").agg(F.count("product_id").alias("prod_count_p_aisle"))
            .withColumn("aisle_with_br", F.regexp_replace("aisle", r"^([^ ]*) ", "$1<br>")))


def dept_reorder_rate(orders: DataFrame, lines: DataFrame, products: DataFrame,
                      departments: DataFrame) -> DataFrame:
    """Reorder percentage per department over prior orders.

    Orders LEFT JOIN lines, so an order without lines is a row of the NULL
    department; ``total_prod_sold`` counts rows, ``reorder_count`` is 0 when
    there is nothing to sum (as the data-frame library of the analysis does).
    """
    from basketlab.operators.product import orders_left_join_lines
    j = (orders_left_join_lines(orders.filter(F.col("eval_set") == "prior"), lines, ["product_id", "reordered"])
         .join(products.select("product_id", "department_id"), "product_id", "left")
         .join(departments, "department_id", "left"))
    return (j.groupBy("department")
            .agg(F.count(F.lit(1)).alias("total_prod_sold"),
                 F.coalesce(F.sum("reordered"), F.lit(0)).alias("reorder_count"))
            .withColumn("reorder_percentage", F.col("reorder_count") / F.col("total_prod_sold") * 100))


def cart_position_reorder(lines: DataFrame) -> DataFrame:
    """Reorder percentage per add-to-cart position, ascending, position as text."""
    return (lines.groupBy("add_to_cart_order")
            .agg(F.count(F.lit(1)).alias("total_count"), F.sum("reordered").alias("reorder_count"))
            .withColumn("reorder_cart_ratio", F.col("reorder_count") / F.col("total_count") * 100)
            .orderBy("add_to_cart_order")
            .withColumn("add_to_cart_order", F.col("add_to_cart_order").cast("string")))
