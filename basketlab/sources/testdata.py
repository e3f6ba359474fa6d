"""Adapter: derive the basket star schema from the TPC-H-like test tables.

Mapping (the oracle SQL implements the same rules independently):

* product = one ``p_name``; ``product_id = min(p_partkey)`` of that name.
  ``p_name`` is "adjective noun": aisle = text before the first space,
  department = text after it; their ids are the smallest product id in them.
* order: ``order_id = o_orderkey``, ``user_id = o_custkey``;
  ``order_number`` = position of the order in the user's history ordered by
  (``o_orderdate``, ``o_orderkey``); ``order_dow`` = weekday (0 = Sunday);
  ``order_hour_of_day = (o_orderkey * 7 + o_custkey) % 24``;
  ``days_since_prior_order`` = day gap to the previous order ``% 31``
  (NULL for the first order).  The last order of a user is ``test`` when
  ``user_id % 3 = 0`` else ``train``; all others are ``prior``.
* order line: one row per (order, product) with ``ln = min(l_linenumber)``;
  ``add_to_cart_order`` = position by (``ln``, ``product_id``) in the order;
  ``reordered = 1`` iff the user bought the product in an earlier order.

The sequence numbers (order number per user, cart position per order) use
:func:`basketlab.functions.sequence.sequence_number_by_group`, which stays
distributed when one user or order holds a large share of the rows; real
inputs carry these columns in the source files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketlab.functions.sequence import sequence_number_by_group
from basketlab.functions.skew import hot_groups, split_by_groups
from basketlab.session import enough_partitions, scratch_path
from basketlab.sources.sinks import write_table
from basketlab.sources.tables import LINE_COLS, BasketTables


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def products_from_part(part: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Return (products, aisles, departments, partkey -> product_id map)."""
    names = (part.groupBy("p_name").agg(F.min("p_partkey").alias("product_id"))
             .select("product_id", F.col("p_name").alias("product_name"),
                     F.substring_index("p_name", " ", 1).alias("aisle"),
                     F.expr("substr(p_name, instr(p_name, ' ') + 1)").alias("department")))
    aisles = names.groupBy("aisle").agg(F.min("product_id").cast("int").alias("aisle_id"))
    departments = names.groupBy("department").agg(F.min("product_id").cast("int").alias("department_id"))
    products = (names.join(aisles, "aisle").join(departments, "department")
                .select("product_id", "product_name", "aisle_id", "department_id"))
    part_map = part.select("p_partkey", "p_name").join(
        names.select(F.col("product_name").alias("p_name"), "product_id"), "p_name")
    return (products, aisles.select("aisle_id", "aisle"),
            departments.select("department_id", "department"),
            part_map.select("p_partkey", "product_id"))


def orders_from_tpch(orders: DataFrame) -> DataFrame:
    o = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                      F.col("o_orderdate").alias("_od"))
    # the previous date and the flag of the last order come with the number: a user may have any number of orders
    o = sequence_number_by_group(o, ["user_id"], ["_od", "order_id"], "order_number", hot_groups(o, ["user_id"]),
                                 previous={"_prev": "_od"}, last="_last")
    return o.select(
        "order_id", "user_id",
        F.when(F.col("_last"),
               F.when(F.col("user_id") % 3 == 0, F.lit("test")).otherwise(F.lit("train")))
         .otherwise(F.lit("prior")).alias("eval_set"),
        "order_number",
        (F.dayofweek(F.to_date("_od")) - 1).cast("int").alias("order_dow"),
        ((F.col("order_id") * 7 + F.col("user_id")) % 24).cast("int").alias("order_hour_of_day"),
        (F.datediff(F.to_date("_od"), F.to_date("_prev")) % 31).cast("int").alias("days_since_prior_order"),
    )


def order_lines_from_tpch(lineitem: DataFrame, part_map: DataFrame, orders: DataFrame) -> DataFrame:
    """All order lines (every eval_set) with ``eval_set`` attached.

    The lines are shuffled once by order, for the aggregate, the cart positions and the join
    with the orders, and once by (user, product) for the first purchase.  Orders and users
    too large for a task take ways that spread them.
    """
    lines = lineitem.select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_linenumber")
    hot_orders, hot_users = hot_groups(lines, ["order_id"]), hot_groups(orders, ["user_id"])

    def per_product(part: DataFrame) -> DataFrame:
        return part.groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("_ln"))

    # the cart position only depends on the order's own lines: number them
    # before the joins that attach the user sequence
    lines = lines.join(part_map, F.col("l_partkey") == F.col("p_partkey"))
    usual, large = split_by_groups(lines, ["order_id"], hot_orders)
    position = (["order_id"], ["_ln", "product_id"], "add_to_cart_order")
    raw = sequence_number_by_group(per_product(usual.repartition("order_id")), *position, [])
    if large is not None:
        raw = raw.unionByName(sequence_number_by_group(per_product(large), *position, hot_orders).select(raw.columns))
    x = raw.join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
    x = x.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
    usual, large = split_by_groups(x, ["user_id"], hot_users)
    pair = ["user_id", "product_id"]
    x = usual.withColumn("_first", F.min("order_number").over(Window.partitionBy(*pair)))
    if large is not None:
        first = large.groupBy(*pair).agg(F.min("order_number").alias("_first"))
        x = x.unionByName(large.join(first, pair).select(x.columns))
    return x.select(
        "order_id", "product_id", "add_to_cart_order",
        (F.col("order_number") > F.col("_first")).cast("int").alias("reordered"),
        "eval_set",
    )


_MATERIALISED: dict[tuple[str, str], BasketTables] = {}


def load_testdata(spark: SparkSession, sf_dir: str, keep: bool = True) -> BasketTables:
    """Build :class:`BasketTables` from ``{sf_dir}/{part,orders,lineitem}.parquet``.

    With ``keep`` the derived star schema is written once per Spark
    application below the shared checkpoint folder and read back, exactly
    like real inputs that arrive as files.  Every query then plans against
    five scans instead of re-deriving the sequence windows in each branch.
    """
    if not keep:
        return _tables(derive_star(spark, sf_dir))
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _MATERIALISED:
        _MATERIALISED[key] = _write_and_read(spark, sf_dir)
    return _MATERIALISED[key]


def _write_and_read(spark: SparkSession, sf_dir: str) -> BasketTables:
    """Write the derived tables in dependency order, each read back before use."""
    tag = f"star_{spark.sparkContext.applicationId}_{abs(hash(os.path.abspath(sf_dir))):x}"
    base = scratch_path(spark, tag)

    def put(name: str, df: DataFrame, partition_by=()) -> DataFrame:
        return spark.read.parquet(write_table(df, f"{base}/{name}", partition_by=partition_by))

    enough_partitions(spark, read_table(spark, sf_dir, "lineitem").count())
    products, aisles, departments, part_map = products_from_part(read_table(spark, sf_dir, "part"))
    star = {"products": put("products", products), "aisles": put("aisles", aisles),
            "departments": put("departments", departments)}
    star["orders"] = put("orders", orders_from_tpch(read_table(spark, sf_dir, "orders")))
    star["order_products"] = put("order_products", order_lines_from_tpch(
        read_table(spark, sf_dir, "lineitem"), part_map, star["orders"]), ("eval_set",))
    return _tables(star)


def derive_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """orders, order_products (all eval_sets, with ``eval_set``), products, aisles, departments."""
    products, aisles, departments, part_map = products_from_part(read_table(spark, sf_dir, "part"))
    orders = orders_from_tpch(read_table(spark, sf_dir, "orders"))
    lines = order_lines_from_tpch(read_table(spark, sf_dir, "lineitem"), part_map, orders)
    return {"orders": orders, "order_products": lines, "products": products,
            "aisles": aisles, "departments": departments}


def _tables(star: dict[str, DataFrame]) -> BasketTables:
    lines, cols = star["order_products"], list(LINE_COLS)

    def lines_of(eval_set: str) -> DataFrame:
        return lines.filter(F.col("eval_set") == eval_set).select(*cols)

    return BasketTables(orders=star["orders"], prior_lines=lines_of("prior"), train_lines=lines_of("train"),
                        products=star["products"], aisles=star["aisles"], departments=star["departments"],
                        test_lines=lines_of("test"))
