"""FeatureSet: all feature groups from one history of orders and lines.

The reference recomputes its ``lines JOIN orders`` nine times and runs two
eager jobs at plan time.  Here the lines are aggregated and joined once (``op``)
and every feature group is a few aggregations of that written table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from basketlab.operators import base as B
from basketlab.operators import product as P
from basketlab.operators import streaks as S
from basketlab.operators import time as TM
from basketlab.operators import user as U
from basketlab.operators import user_product as X
from basketlab.functions.joins import sized_for_broadcast
from basketlab.schemas import cast_by_type, require_columns
from basketlab.session import enough_partitions, materialize
from basketlab.sources.tables import BasketTables, LINE_COLS

TRAIN_MATRIX_COLUMNS = ("user_id", "product_id", "reordered", *TM.TIME_FEATURES, *U.USER_FEATURES,
                        *P.PRODUCT_FEATURES, *X.USER_PRODUCT_FEATURES)


UNFOLD = 1024  # lines of an (order, product) that are unfolded at once


class FeatureSet:
    """Feature groups over ``lines`` (history order lines) and ``orders``.

    ``streak_mode`` picks the reference-compatible (``compat``, default) or
    the corrected (``island``) streak grouping; ``keywords`` are the product
    name substrings of the keyword user feature.

    ``materialize`` writes the per-(order, product) table, which five feature
    aggregations read, as a Parquet table in the shared checkpoint folder:
    Spark cannot reuse exchanges across branches that prune different
    columns, so without it the lines x orders join would run once per
    branch.  The written table also cuts the lineage for executor loss.
    ``table_dir`` names where the feature tables are written (default: a
    fresh folder below the checkpoint folder).

    ``target_lines`` with their ``target_orders`` are the labelled lines of the
    train matrix where they aren't the history itself (the default, as in the
    original): their labels then have no part in the features.
    """

    def __init__(self, lines: DataFrame, orders: DataFrame, products: DataFrame,
                 keywords: Sequence[str] = B.DEFAULT_KEYWORDS, streak_mode: str = "compat",
                 materialize: bool = True, table_dir: str | None = None,
                 target_lines: DataFrame | None = None, target_orders: DataFrame | None = None):
        require_columns(lines, *LINE_COLS, what="order lines")
        require_columns(orders, "order_id", *B.ORDER_ATTRS, what="orders")
        require_columns(products, "product_id", "product_name", what="products")
        if streak_mode not in S.STREAK_MODES:
            raise ValueError(f"streak_mode must be one of {S.STREAK_MODES}")
        self.lines, self.orders, self.products = lines, orders, products
        self.keywords, self.streak_mode = tuple(keywords), streak_mode
        self.materialize, self.table_dir = materialize, table_dir
        if (target_lines is None) != (target_orders is None):
            raise ValueError("target_lines and target_orders go together")
        self.target_lines, self.target_orders = target_lines, target_orders

    @classmethod
    def from_tables(cls, t: BasketTables, **kw) -> FeatureSet:
        """History = train + prior lines and all non-test orders (as the reference job)."""
        return cls(t.history_lines(), t.history_orders(), t.products, **kw)

    # -- shared intermediates -------------------------------------------
    @cached_property
    def base(self) -> DataFrame:
        return B.base_lines(self.lines, self.orders)

    @cached_property
    def op(self) -> DataFrame:
        if not self.materialize:
            return B.order_product_stats(self.lines, self.orders)
        op = materialize(B.order_product_stats_by_order(self.lines, self.orders, lambda df: materialize(df, "order_product_lines")), "order_product_stats")
        enough_partitions(op.sparkSession, op.count())
        return op

    @cached_property
    def order_stats(self) -> DataFrame:
        return B.order_stats(self.op, self.products, self.keywords)

    def streak_lengths(self, mode: str | None = None) -> DataFrame:
        return S.streak_lengths(self.op, mode or self.streak_mode)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        return materialize(df, name, path=f"{self.table_dir.rstrip('/')}/{name}" if self.table_dir else None)

    # -- feature groups ---------------------------------------------------
    def user_features(self) -> DataFrame:
        return U.user_features(self.order_stats)

    def product_features(self) -> DataFrame:
        return P.product_features(self.op, S.product_streak_stats(self.streak_lengths()), self.orders)

    def user_product_features(self) -> DataFrame:
        return X.user_product_features(self.op)

    @cached_property
    def feature_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(user, product, user-product) features, materialised once for the matrices."""
        return (self._keep(self.user_features(), "user_features"),
                self._keep(self.product_features(), "product_features"),
                self._keep(self.user_product_features(), "user_product_features"))

    def time_features(self) -> DataFrame:
        return TM.time_features(self.orders)

    def time_means(self) -> DataFrame:
        return TM.time_means(self.orders)

    def _line_spine(self) -> DataFrame:
        """One row per history line with its order attributes.

        The per-(order, product) table knows how many lines a row stands for and
        how many of them are reordered, not reordered and without a label, so
        the lines are not joined with the orders a second time: a row is unfolded
        into its lines, in parts of ``UNFOLD``.
        """
        cols = ("user_id", "product_id", "reordered", "order_dow", "order_hour_of_day")
        if self.target_lines is not None:
            return B.base_lines(self.target_lines, self.target_orders).select(*cols)
        part, zero = F.col("part") * UNFOLD, F.lit(0).cast("long")
        line = F.when(F.col("line") < F.col("reord_sum"), 1).when(F.col("line") < F.col("reord_cnt"), 0)
        return (self.op.withColumn("part", F.explode(F.sequence(zero, F.floor((F.col("m") - 1) / UNFOLD))))
                .withColumn("line", F.explode(F.sequence(part, F.least(part + UNFOLD, "m") - 1)))
                .withColumn("reordered", line.cast("int")).select(*cols))

    def train_matrix(self) -> DataFrame:
        """A1: one row per history line: keys, label and the 34 features.

        The per-order time counts are looked up by weekday / hour on the
        line spine (which already carries both) in maps of 7 and 24 entries, so
        the spine isn't shuffled for them.  The line table is shuffled for the
        (user, product) join; the product (and, if small, the user) features
        are broadcast after a measured size check, otherwise they are shuffle
        joins whose hot keys adaptive execution splits.
        """
        user_f, prod_f, up_f = self.feature_tables
        if self.materialize:
            user_f, prod_f = sized_for_broadcast(user_f), sized_for_broadcast(prod_f)
        m = (TM.with_time_counts(self._line_spine(), self.orders)
             .join(up_f, ["user_id", "product_id"], "left")
             .join(prod_f, "product_id", "left")
             .join(user_f, "user_id", "left"))
        m = cast_by_type(m.select(*TRAIN_MATRIX_COLUMNS), T.LongType, T.DoubleType())
        return cast_by_type(m, T.StringType, T.DoubleType(), safe=True)

    # -- entry points under the original pipeline's method names ------------
    def generate_user_related_features(self) -> DataFrame:
        return self.user_features()

    def generate_product_related_features(self) -> DataFrame:
        return self.product_features()

    def generate_user_product_related_features(self) -> DataFrame:
        return self.user_product_features()

    def generate_time_related_features(self) -> DataFrame:
        return self.time_features()

    def generate_all_types_of_features(self) -> DataFrame:
        return self.train_matrix()
