"""Product features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from basketlab.schemas import cast_by_type

DOW_VALUES = tuple(range(7))

# The product feature column names and their order in the
# matrices (spelling kept exactly, as models and manifests refer to them).
PRODUCT_FEATURES = (
    "product_mean_of_position", "number_of_user_purchased_item", "number_of_product_co_occurred",
    "mean_of_co_ocuured_product_per_order", "min_of_co_ocuured_product_per_order",
    "max_of_co_ocuured_product_per_order", "Total_streak_of_this_product",
    "mean_of_streaks_of_this_product", "min_of_streaks_of_this_product",
    "max_of_streaks_of_this_product", "prob_of_reordered_5", "prob_of_reordered_3",
    "prob_of_reordered_2",
    "distrib_count_of_dow_0_p_prod", "distrib_count_of_dow_1_p_prod", "distrib_count_of_dow_2_p_prod",
    "distrib_count_of_dow_3_p_prod", "distrib_count_of_dow_4_p_prod", "distrib_count_of_dow_5_p_prod",
    "distrib_count_of_dow_6_p_prod",
    "prob_of_being_reordered",
)


def product_purchase_count(lines: DataFrame) -> DataFrame:
    """Lines per product."""
    return lines.groupBy("product_id").agg(F.count("order_id").alias("product_count"))


def product_cart_position(lines: DataFrame) -> DataFrame:
    """Mean add-to-cart position."""
    return lines.groupBy("product_id").agg(F.avg("add_to_cart_order").alias("product_mean_of_position"))


def product_reorder_rate(lines: DataFrame) -> DataFrame:
    """Corrected reorder probability: share of the product's lines that are reorders."""
    return lines.groupBy("product_id").agg(F.avg("reordered").alias("reorder_rate"))


def product_one_shot_users(op: DataFrame) -> DataFrame:
    """Users who bought the product at least once as the only product of an order.

    Two partial aggregations ((product, user) then product) instead of
    ``collect_list`` + ``explode`` + ``array_contains``.
    """
    return (op.filter(F.col("product_id").isNotNull())
            .groupBy("product_id", "user_id")
            .agg(F.max(F.when(F.col("basket_size") == 1, 1).otherwise(0)).alias("one_shot"))
            .groupBy("product_id").agg(F.sum("one_shot").alias("number_of_user_purchased_item")))


def product_cooccurrence(op: DataFrame) -> DataFrame:
    """Lines of other products in all orders containing the product."""
    return op.groupBy("product_id").agg(F.sum("co").alias("number_of_product_co_occurred"))


def product_cooc_per_order(op: DataFrame) -> DataFrame:
    """P5: mean / min / max of the per-(product, order) co-occurrence count."""
    c = F.col("co")
    return op.groupBy("product_id").agg(F.avg(c).alias("mean_of_co_ocuured_product_per_order"),
                                        F.min(c).alias("min_of_co_ocuured_product_per_order"),
                                        F.max(c).alias("max_of_co_ocuured_product_per_order"))


def order_dow_pivot(orders: DataFrame) -> DataFrame:
    """One 0/1 column per weekday for each order (``dow_0`` .. ``dow_6``).

    ``order_id`` is the key of ``orders``, so the reference's
    ``groupBy(order_id).pivot(order_dow)`` is a projection: no shuffle, and
    the weekday values are fixed so no job runs at plan time.
    """
    dow = F.col("order_dow")
    return orders.select("order_id", *(F.when(dow == k, 1).otherwise(0).alias(f"dow_{k}") for k in DOW_VALUES))


def _dow_sums(weight):
    dow = F.col("order_dow")
    return [F.sum((dow == k).cast("int") * weight).alias(f"distrib_count_of_dow_{k}_p_prod") for k in DOW_VALUES]


def product_dow_distribution(base: DataFrame) -> DataFrame:
    """Lines of the product per order weekday (conditional sums, no pivot)."""
    return base.groupBy("product_id").agg(*_dow_sums(F.lit(1)))


def total_orders(orders: DataFrame):
    """Scalar subquery: number of distinct orders (planned lazily, no collect)."""
    return orders.select(F.count_distinct("order_id")).scalar()


def orders_left_join_lines(orders: DataFrame, lines: DataFrame, line_cols: list[str]) -> DataFrame:
    """Rows of ``orders LEFT JOIN lines`` on ``order_id`` (line columns only).

    Written so the line table is always the left, splittable side: lines
    whose order exists (LEFT SEMI JOIN), plus one all-NULL row per order
    without lines (anti join against the pre-aggregated distinct line order
    ids).  A hot order therefore never sits on the unsplittable side.
    """
    o = orders.select("order_id")
    with_lines = lines.select("order_id", *line_cols).join(o, "order_id", "left_semi").drop("order_id")
    lineless = (o.join(lines.select("order_id").distinct(), "order_id", "left_anti")
                .select(*[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in line_cols]))
    return with_lines.unionByName(lineless)


def prod_order_share(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """P14 as in the reference: lines of the product / distinct orders.

    Rows of ``orders LEFT JOIN lines``: orders without lines form a NULL
    product group.  This is the product's *support*, not a reorder probability.
    """
    j = orders_left_join_lines(orders, lines, ["product_id"])
    return (j.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
            .select("product_id", (F.col("n") / total_orders(orders)).alias("prob_of_being_reordered")))


def product_features(op: DataFrame, streak_stats: DataFrame, history_orders: DataFrame) -> DataFrame:
    """The 21 product features.

    Spine = products of the history lines (as P2).  One aggregation over the
    per-(order, product) table yields P2, P4, P5, P13 and the P14 numerator;
    P3 and the streak statistics are the only joins (the reference chains ten).
    """
    matched = F.col("order_matched").cast("int")
    core = op.groupBy("product_id").agg(
        F.try_divide(F.sum("cart_sum"), F.sum("cart_cnt")).alias("product_mean_of_position"),
        F.sum("co").alias("number_of_product_co_occurred"),
        F.avg("co").alias("mean_of_co_ocuured_product_per_order"),
        F.min("co").alias("min_of_co_ocuured_product_per_order"),
        F.max("co").alias("max_of_co_ocuured_product_per_order"),
        *_dow_sums(F.col("m")),
        F.sum(F.col("m") * matched).alias("_matched_lines"),
    )
    core = core.withColumn("prob_of_being_reordered",
                           F.col("_matched_lines") / total_orders(history_orders)).drop("_matched_lines")
    out = (core.join(product_one_shot_users(op), "product_id", "left")
           .join(streak_stats, "product_id", "left"))
    out = out.select("product_id", *PRODUCT_FEATURES)
    return cast_by_type(out, T.LongType, T.DoubleType())
