"""Joins against derived dimension tables with a measured broadcast decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

_WIDTH = {T.LongType: 8, T.DoubleType: 8, T.IntegerType: 4, T.FloatType: 4, T.ShortType: 2,
          T.ByteType: 1, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8}


def row_width(schema: T.StructType) -> int:
    """Rough in-memory bytes per row (strings counted as 32 bytes)."""
    return 16 + sum(_WIDTH.get(type(f.dataType), 32) for f in schema.fields)


def broadcast_limit(df: DataFrame) -> int:
    return bytes_of(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def bytes_of(setting: str) -> int:
    """A size setting such as ``10485760``, ``64MB`` or ``1g`` in bytes."""
    v = str(setting).strip().lower()
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    for suf in ("kb", "mb", "gb", "k", "m", "g", "b"):
        if v.endswith(suf):
            return int(float(v[: -len(suf)]) * mult.get(suf[0], 1))
    return int(v)


def sized_for_broadcast(dim: DataFrame, limit: int | None = None) -> DataFrame:
    """Mark ``dim`` for broadcast only if its *measured* size is under the limit.

    ``dim`` must be materialised (checkpoint / written table): the row count
    is then a cheap scan of a small file set.  Over the limit (or when
    broadcasting is disabled with -1) the join stays a shuffle join and
    adaptive execution may still convert it at run time.
    """
    limit = broadcast_limit(dim) if limit is None else limit
    if limit <= 0:
        return dim
    return F.broadcast(dim) if dim.count() * row_width(dim.schema) <= limit else dim
