"""User x product features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from basketlab.schemas import cast_by_type

# The user x product feature column names and their order.
USER_PRODUCT_FEATURES = ("num_of_ord_purch_p_prod", "prod_mean_of_position_p_user",
                         "num_of_prod_co_ocrd_p_usr_p_prod")


def up_order_count(base: DataFrame) -> DataFrame:
    """Lines of the product bought by the user."""
    return base.groupBy("user_id", "product_id").agg(F.count("order_id").alias("num_of_ord_purch_p_prod"))


def up_cart_position(base: DataFrame) -> DataFrame:
    """Mean add-to-cart position of the product for the user."""
    return base.groupBy("user_id", "product_id").agg(
        F.avg("add_to_cart_order").alias("prod_mean_of_position_p_user"))


def up_cooccurrence(op: DataFrame) -> DataFrame:
    """Lines of other products in the user's orders containing the product."""
    return op.groupBy("user_id", "product_id").agg(F.sum("co").alias("num_of_prod_co_ocrd_p_usr_p_prod"))


def user_product_features(op: DataFrame) -> DataFrame:
    """X1-X3 in one aggregation (the reference runs three and joins them)."""
    out = op.groupBy("user_id", "product_id").agg(
        F.sum("m").alias("num_of_ord_purch_p_prod"),
        F.try_divide(F.sum("cart_sum"), F.sum("cart_cnt")).alias("prod_mean_of_position_p_user"),
        F.sum("co").alias("num_of_prod_co_ocrd_p_usr_p_prod"),
    )
    return cast_by_type(out, T.LongType, T.DoubleType())
