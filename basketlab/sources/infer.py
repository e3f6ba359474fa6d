"""Type inference over all rows of a header-CSV file.

Each value has a most specific class; a column's state is the number of its
values per class, so states of parts merge by addition and one aggregate with
map-side combination covers every row.  The column's type is the least one in
the lattice that holds all classes seen::

    int < long < double < string,  boolean < string,  date < timestamp < string

A column whose values belong to different families (numbers, truth values,
dates, text) is a conflict: its type widens to string, and the report says how
many values lie outside the largest family.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CLASSES = ("boolean", "int", "long", "double", "date", "timestamp", "string")
FAMILIES = {"boolean": ("boolean",), "number": ("int", "long", "double"), "time": ("date", "timestamp"), "text": ("string",)}
SQL_TYPES = {"int": "int", "long": "bigint", "double": "double", "boolean": "boolean", "date": "date", "timestamp": "timestamp_ntz", "string": "string"}


def value_class(text: Column) -> Column:
    """Most specific class of a trimmed text; NULL for an empty one."""
    whole = text.rlike(r"^[+-]?[0-9]{1,20}$")
    return (F.when(text.isNull() | (text == ""), None)
            .when(F.lower(text).isin("true", "false"), "boolean")
            .when(whole & text.try_cast("int").isNotNull(), "int")
            .when(whole & text.try_cast("bigint").isNotNull(), "long")
            .when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"), "double")
            .when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull(), "date")
            .when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$")
                  & text.try_cast("timestamp_ntz").isNotNull(), "timestamp")
            .otherwise("string"))


def type_states(raw: DataFrame) -> DataFrame:
    """One row per column of a table of texts, in their order: ``position, column_name, rows, nulls`` and a count per class."""
    cells = raw.select(F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), value_class(F.trim(F.col(f"`{c}`"))).alias("class"))
                                          for i, c in enumerate(raw.columns)])))
    return cells.groupBy("position", "column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("class").isNull()).alias("nulls"),
        *[F.count_if(F.col("class") == c).alias(f"n_{c}") for c in CLASSES])


def with_type(states: DataFrame) -> DataFrame:
    """Adds the inferred type and ``conflicts``, the values outside the largest family."""
    seen = {c: F.col(f"n_{c}") > 0 for c in CLASSES}
    totals = {f: sum((F.col(f"n_{c}") for c in own), F.lit(0).cast("long")) for f, own in FAMILIES.items()}
    families = sum((F.when(n > 0, 1).otherwise(0) for n in totals.values()), F.lit(0))
    kind = (F.when((families != 1) | seen["string"], "string").when(seen["boolean"], "boolean")
            .when(seen["double"], "double").when(seen["long"], "long").when(seen["int"], "int")
            .when(seen["timestamp"], "timestamp").otherwise("date"))
    return states.withColumn("inferred", kind).withColumn("conflicts", sum(totals.values(), F.lit(0).cast("long")) - F.greatest(*totals.values()))


def infer_types(spark: SparkSession, path: str) -> DataFrame:
    """The type report of a header-CSV file: one row per column, from all rows."""
    return with_type(type_states(spark.read.option("header", True).option("inferSchema", False).csv(path)))


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A header-CSV file with the inferred types; empty values are NULL (S2).  A table without rows has texts only."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    kinds = {r.column_name: r.inferred for r in with_type(type_states(raw)).select("column_name", "inferred").collect()}  # a row per column

    def column(c: str) -> Column:
        own, kind = F.col(f"`{c}`"), kinds.get(c, "string")
        return (own if kind == "string" else F.nullif(F.trim(own), F.lit("")).cast(SQL_TYPES[kind])).alias(c)

    return raw.select([column(c) for c in raw.columns])
