"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlab.session import materialize


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns ``doc_id``, ``text``; a null text counts as empty.

    Only these two columns of the input are read, so further columns (also
    ones named like an operator's results) can't clash.
    """
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back."""
    return materialize(df, name)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps whose results are written.

    The cleaner acts when the driver's JVM collects the plans of those steps,
    which a small driver heap may put off for a long time.
    """
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_slices(batches, max_bytes: int = 4 << 20) -> Iterator[tuple[list, list]]:
    """Arrow batches of (id, text) cut into lists of about ``max_bytes`` of text.

    A single longer text makes a slice of its own; texts are never cut.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        if not len(ids):
            continue
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start, base = 0, 0
        while start < len(ids):
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield ids.slice(start, stop - start).to_pylist(), texts.slice(start, stop - start).to_pylist()
            start, base = stop, int(ends[stop - 1])
