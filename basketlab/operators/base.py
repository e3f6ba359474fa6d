"""Shared building blocks: the joined base and the per-order aggregates.

Physical shape (checked with ``explain``): the lines are aggregated per (order,
product) before anything is joined, and the orders are joined once with those
rows.  One shuffle of the lines by order serves the aggregate, the basket sizes and
the join; orders too large for a task are aggregated and joined by themselves.  ``base_lines`` is the line-level join for the consumers that need one row
per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlab.functions.skew import hot_groups, split_by_groups
from basketlab.sources.tables import LINE_COLS

# The product-name keywords of the "asian / gluten free /
# organic" user feature (matched case-insensitively as substrings).
DEFAULT_KEYWORDS = ("organic", "asian", "gluten free")

ORDER_ATTRS = ("user_id", "order_number", "order_dow", "order_hour_of_day")


def base_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """History lines LEFT JOIN orders on ``order_id`` (done once).

    ``order_matched`` is TRUE when the line's order exists (NULL otherwise);
    it is what the orders-driven joins of the reference observe.
    """
    o = orders.select("order_id", *ORDER_ATTRS, F.lit(True).alias("order_matched"))
    return lines.select(*LINE_COLS).join(o, "order_id", "left")


def keyword_flag(name: Column, keywords: Sequence[str]) -> Column:
    """``lower(name) LIKE '%kw%'`` OR-ed over the keywords (NULL name -> NULL)."""
    low = F.lower(name)
    flag = None
    for kw in keywords:
        term = low.like(f"%{kw.lower()}%")
        flag = term if flag is None else (flag | term)
    return flag if flag is not None else F.lit(False)


def _lines_per_product(lines: DataFrame) -> DataFrame:
    return (lines.groupBy("order_id", "product_id")
            .agg(F.count(F.lit(1)).alias("m"),
                 F.sum("add_to_cart_order").alias("cart_sum"),
                 F.count("add_to_cart_order").alias("cart_cnt"),
                 F.sum("reordered").alias("reord_sum"),
                 F.count("reordered").alias("reord_cnt"),
                 F.max(F.col("reordered") == 1).alias("reord_any")))


def _with_orders(sized: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows with their basket size joined with the orders, and ``co``."""
    o = orders.select("order_id", *ORDER_ATTRS, F.lit(True).alias("order_matched"))
    co = F.when(F.col("product_id").isNull() | F.col("order_id").isNull(), F.lit(0)).otherwise(
        F.col("m") * (F.col("basket_size") - F.col("m")))
    return sized.join(o, "order_id", "left").withColumn("co", co)


def order_product_stats_by_order(lines: DataFrame, orders: DataFrame, keep=None) -> DataFrame:
    """:func:`order_product_stats` with one shuffle of the lines; ``keep`` is for the lines of orders too large for a task.

    The lines are read twice: a first pass over their order ids finds such orders.
    """
    lines = lines.select(*LINE_COLS)
    usual, large = split_by_groups(lines, ["order_id"], hot_groups(lines, ["order_id"]))
    op = _lines_per_product(usual.repartition("order_id"))
    size = F.sum(F.when(F.col("product_id").isNotNull(), F.col("m"))).over(Window.partitionBy("order_id"))
    out = _with_orders(op.withColumn("basket_size", F.coalesce(size, F.lit(0))), orders)
    return out if large is None else out.unionByName(order_product_stats(large, orders, keep).select(out.columns))


def order_product_stats(lines: DataFrame, orders: DataFrame, keep=None) -> DataFrame:
    """One row per (order, product) with line multiplicity and co-occurrence, and the order's attributes.

    ``co`` = lines of *other* products in the same order, summed over the
    ``m`` lines of this product: ``m * (size - m)`` where ``size`` counts the
    order's non-null product lines.  That is the number of (same order,
    different product) pairs, without emitting any pair (NULL products and
    NULL orders never match, so their ``co`` is 0).

    Multiplicities and basket sizes need the lines only, so the orders are
    joined once, with the aggregated rows.  ``keep`` (a function from
    DataFrame to DataFrame) may write the aggregated lines, which are read
    twice; without it the lines are scanned for each use.
    """
    op = _lines_per_product(lines.select(*LINE_COLS))
    op = keep(op) if keep else op
    size = (op.groupBy(F.col("order_id").alias("_o"))
            .agg(F.coalesce(F.sum(F.when(F.col("product_id").isNotNull(), F.col("m"))), F.lit(0))
                 .alias("basket_size")))
    return _with_orders(op.join(size, F.col("order_id").eqNullSafe(F.col("_o"))).drop("_o"), orders)


def order_stats(op: DataFrame, products: DataFrame,
                keywords: Sequence[str] = DEFAULT_KEYWORDS) -> DataFrame:
    """One row per (user, order): the inputs of U1 and U3-U9.

    Replaces the reference's ``collect_list`` + ``exists`` / ``array_contains``
    with ``max`` of a boolean: constant memory per order.
    """
    kw = products.select("product_id", keyword_flag(F.col("product_name"), keywords).alias("kw"))
    return (op.join(kw, "product_id", "left")
            .groupBy("user_id", "order_id")
            .agg(F.sum("reord_cnt").alias("reordered_lines"),
                 F.max("basket_size").alias("basket_size"),
                 F.coalesce(F.max("kw"), F.lit(False)).alias("has_keyword"),
                 F.coalesce(F.max("reord_any"), F.lit(False)).alias("has_reordered")))
