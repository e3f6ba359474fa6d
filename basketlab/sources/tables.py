"""The basket star schema as a bundle of DataFrames, plus the standard splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

LINE_COLS = ("order_id", "product_id", "add_to_cart_order", "reordered")
HISTORY_ORDER_COLS = ("order_id", "user_id", "order_number", "order_dow",
                      "order_hour_of_day", "days_since_prior_order")


@dataclass(frozen=True)
class BasketTables:
    """Typed inputs: orders, prior / train order lines, products, dimensions.

    ``test_lines`` are order lines of ``eval_set = 'test'`` orders; they are
    held-out labels (only used to label candidates for evaluation).
    """

    orders: DataFrame
    prior_lines: DataFrame
    train_lines: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame
    test_lines: DataFrame | None = None

    # -- standard splits (S10, F4) -------------------------------------
    def history_lines(self) -> DataFrame:
        """train + prior lines, unioned by *name* (a positional union would
        silently swap columns when the files differ in column order)."""
        cols = list(LINE_COLS)
        return self.train_lines.select(*cols).unionByName(self.prior_lines.select(*cols))

    def history_orders(self) -> DataFrame:
        """Non-test orders without ``eval_set``.  ``!=`` also drops NULL sets."""
        return self.orders.filter(F.col("eval_set") != "test").drop("eval_set")

    def test_orders(self) -> DataFrame:
        return self.orders.filter(F.col("eval_set") == "test").select("order_id", "user_id")
