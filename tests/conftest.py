import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("basketlab-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def make_tables(spark, orders, lines, products, test_lines=None):
    """BasketTables from plain tuples (orders carry eval_set)."""
    from basketlab.schemas import AISLES, DEPARTMENTS, ORDER_PRODUCTS, ORDERS, PRODUCTS
    from basketlab.sources.tables import BasketTables
    o = spark.createDataFrame(orders, ORDERS)
    ln = spark.createDataFrame(lines, ORDER_PRODUCTS)
    empty = spark.createDataFrame([], ORDER_PRODUCTS)
    return BasketTables(orders=o, prior_lines=ln, train_lines=empty,
                        products=spark.createDataFrame(products, PRODUCTS),
                        aisles=spark.createDataFrame([], AISLES),
                        departments=spark.createDataFrame([], DEPARTMENTS),
                        test_lines=spark.createDataFrame(test_lines or [], ORDER_PRODUCTS))


def rows(df, *cols, key=None):
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=key or (lambda t: tuple((x is None, x) for x in t)))
