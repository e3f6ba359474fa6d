"""Typed schemas of the basket star schema and schema utilities.

The source files are header CSVs.  They are always read with an explicit
``StructType`` (never inferred), ids as 64-bit integers: a 32-bit float id
column silently merges ids above 2**24.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("eval_set", T.StringType()),
    T.StructField("order_number", T.IntegerType()),
    T.StructField("order_dow", T.IntegerType()),
    T.StructField("order_hour_of_day", T.IntegerType()),
    T.StructField("days_since_prior_order", T.IntegerType()),
])

ORDER_PRODUCTS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("add_to_cart_order", T.IntegerType()),
    T.StructField("reordered", T.IntegerType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("aisle_id", T.IntegerType()),
    T.StructField("department_id", T.IntegerType()),
])

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.IntegerType()),
    T.StructField("department", T.StringType()),
])

AISLES = T.StructType([
    T.StructField("aisle_id", T.IntegerType()),
    T.StructField("aisle", T.StringType()),
])

SOURCE_SCHEMAS = {
    "orders": ORDERS,
    "order_products__prior": ORDER_PRODUCTS,
    "order_products__train": ORDER_PRODUCTS,
    "products": PRODUCTS,
    "departments": DEPARTMENTS,
    "aisles": AISLES,
}

# Join keys are never cast to double by the feature casts.
KEY_COLUMNS = ("user_id", "product_id", "order_id")


def require_columns(df: DataFrame, *cols: str, what: str = "DataFrame") -> None:
    """Raise ``ValueError`` at plan time if any column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing column(s): {', '.join(missing)}")


def cast_by_type(df: DataFrame, source: type[T.DataType] | tuple,
                 target: T.DataType, exclude: Iterable[str] = KEY_COLUMNS,
                 safe: bool = False) -> DataFrame:
    """Cast every column whose type is ``source`` to ``target``.

    Used for the LONG -> DOUBLE feature casts and STRING -> DOUBLE matrix
    casts.  ``safe=True`` uses ``try_cast`` (ANSI mode throws on '' -> double).
    """
    skip = set(exclude)
    todo = {f.name: (F.col(f.name).try_cast(target) if safe else F.col(f.name).cast(target))
            for f in df.schema.fields
            if isinstance(f.dataType, source) and f.name not in skip}
    return df.withColumns(todo) if todo else df


def cast_bulk(df: DataFrame, target: str | T.DataType, except_cols: Iterable[str] = (), safe: bool = True) -> DataFrame:
    """Cast every column to ``target`` except the listed ones (order kept).

    ``safe`` turns values that can't be cast into NULL; without it they fail the job (ANSI mode).
    """
    keep = set(except_cols)
    cast = (lambda c: F.col(c).try_cast(target)) if safe else (lambda c: F.col(c).cast(target))
    return df.select([F.col(c) if c in keep else cast(c).alias(c) for c in df.columns])
