"""Writers (S5, S6): Parquet by default, header-less CSV + schema manifest on request.

No ``coalesce(1)``: every task writes its own part file.  The schema
manifest is written through Spark, so it works for any Hadoop URI.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> str:
    """Write ``df`` to ``path``; CSV data goes to ``path/data`` with the schema in ``path/schema``."""
    if fmt == "parquet":
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    elif fmt == "csv":
        spark = df.sparkSession
        spark.createDataFrame([(df.schema.json(),)], "value string").write.mode(mode).text(path + "/schema")
        w = df.write.mode(mode).option("header", False)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.csv(path + "/data")
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path
