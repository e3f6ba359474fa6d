"""Time features (T1-T3) and the scalar time means (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from basketlab.schemas import cast_by_type

# The time feature column names.
TIME_FEATURES = ("total_ord_count_p_dow", "total_ord_count_p_ohod")


def orders_per_dow(orders: DataFrame) -> DataFrame:
    """Orders per weekday."""
    return orders.groupBy("order_dow").agg(F.count("order_id").alias("total_ord_count_p_dow"))


def orders_per_hour(orders: DataFrame) -> DataFrame:
    """Orders per hour of day."""
    return orders.groupBy("order_hour_of_day").agg(F.count("order_id").alias("total_ord_count_p_ohod"))


def _counts_map(counts: DataFrame, key: str, value: str):
    """A key -> count table as one map, for a scalar subquery (a weekday has 7 values, an hour 24)."""
    entries = F.collect_list(F.struct(key, value))
    return counts.filter(F.col(key).isNotNull()).agg(F.map_from_entries(entries).alias("m")).scalar()


def with_time_counts(df: DataFrame, orders: DataFrame) -> DataFrame:
    """Adds the number of orders on the row's weekday and in its hour (NULL where there is none).

    The counts are looked up in two small maps: a join on seven keys would
    shuffle all rows of ``df`` into seven partitions.
    """
    dow = _counts_map(orders_per_dow(orders), "order_dow", TIME_FEATURES[0])
    hour = _counts_map(orders_per_hour(orders), "order_hour_of_day", TIME_FEATURES[1])
    return df.withColumns({TIME_FEATURES[0]: F.try_element_at(dow, F.col("order_dow")),
                           TIME_FEATURES[1]: F.try_element_at(hour, F.col("order_hour_of_day"))})


def time_features(orders: DataFrame) -> DataFrame:
    """Per order, the number of orders sharing its weekday and its hour."""
    t = (with_time_counts(orders.select("user_id", "order_id", "order_dow", "order_hour_of_day"), orders)
         .select("user_id", "order_id", F.col("order_dow").alias("dow"),
                 F.col("order_hour_of_day").alias("hour_of_day"), *TIME_FEATURES))
    return cast_by_type(t, T.LongType, T.DoubleType())


def time_means(orders: DataFrame) -> DataFrame:
    """A3, corrected: mean over weekdays (hours) of the orders-per-weekday (hour) count.

    The reference took ``groupBy(dow).agg(mean).collect()[0][0]``, i.e. the
    weekday *value* of an arbitrary row.  Here: one row, computed lazily.
    """
    d = orders_per_dow(orders).agg(F.avg("total_ord_count_p_dow").alias("time_mean_dow_count"))
    h = orders_per_hour(orders).agg(F.avg("total_ord_count_p_ohod").alias("time_mean_ohod_count"))
    return d.select("time_mean_dow_count", h.scalar().alias("time_mean_ohod_count"))
