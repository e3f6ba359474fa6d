"""Readers for the header-CSV source files and for written matrices."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from basketlab.schemas import SOURCE_SCHEMAS, require_columns
from basketlab.sources.tables import BasketTables


def _number(name: str, kind: T.DataType):
    """A text column as an integer: ``8``, ``08`` and ``8.0`` are 8, empty is NULL, anything else fails the job."""
    text = F.trim(F.col(name))
    value = text.try_cast("decimal(38,9)")
    whole = F.when(value == F.floor(value), value.cast(kind))
    wrong = F.raise_error(F.concat(F.lit(f"column {name}: not an integer: "), text)).cast(kind)
    return F.when(text.isNull() | (text == ""), F.lit(None).cast(kind)).otherwise(F.coalesce(whole, wrong)).alias(name)


def read_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read one source table: columns by their header names, with the declared types.

    The file's column order doesn't matter and further columns are left out; a
    missing column raises ``ValueError`` and a malformed number fails the job.
    """
    if name not in SOURCE_SCHEMAS:
        raise ValueError(f"unknown source table {name!r}; expected one of {sorted(SOURCE_SCHEMAS)}")
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    require_columns(raw, *SOURCE_SCHEMAS[name].names, what=f"{name} ({path})")
    return raw.select([F.col(f.name) if isinstance(f.dataType, T.StringType) else _number(f.name, f.dataType)
                       for f in SOURCE_SCHEMAS[name].fields])


def load_csv_tables(spark: SparkSession, orders: str, prior: str, train: str, products: str,
                    departments: str | None = None, aisles: str | None = None) -> BasketTables:
    """The star schema from its CSV files (departments / aisles are optional)."""
    def dim(name: str, path: str | None) -> DataFrame:
        if path:
            return read_source(spark, name, path)
        return spark.createDataFrame([], SOURCE_SCHEMAS[name])

    return BasketTables(orders=read_source(spark, "orders", orders),
                        prior_lines=read_source(spark, "order_products__prior", prior),
                        train_lines=read_source(spark, "order_products__train", train),
                        products=read_source(spark, "products", products),
                        aisles=dim("aisles", aisles), departments=dim("departments", departments))


def read_schema_manifest(spark: SparkSession, path: str) -> T.StructType:
    """The schema written next to a matrix by :func:`basketlab.sources.sinks.write_table`."""
    text = spark.read.text(path.rstrip("/") + "/schema").first()[0]
    return T.StructType.fromJson(json.loads(text))


def read_matrix(spark: SparkSession, path: str, fmt: str = "parquet",
                label: str | None = None) -> DataFrame:
    """Read a written matrix.  Header-less CSV gets its names and types from the
    manifest (the reference attached a comma-separated name list by hand).
    ``label`` checks that the label column is present.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        df = spark.read.schema(read_schema_manifest(spark, path)).option("header", False).csv(path + "/data")
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    if label is not None and label not in df.columns:
        raise ValueError(f"label column {label!r} not in matrix columns")
    return df


def with_label_first(df: DataFrame, label: str) -> DataFrame:
    """Put the label first (label lookup by name, never by index)."""
    return df.select(F.col(label), *[c for c in df.columns if c != label])
