"""Row numbers within groups that stay distributed when one group is huge.

``row_number() over (partition by g order by o)`` puts every row of a group
into one task.  Here the rows are range-partitioned on (g, o), so a hot group
is spread over consecutive partitions; each (partition, group) slice is
numbered locally and shifted by the number of rows of the same group in
earlier partitions.  Only the first group of a partition can continue from
earlier partitions and only its last group goes on in later ones, so the shift
table has at most two rows per partition and is broadcast with that bound.

That costs a sample, a written copy and two more shuffles of all rows, so
:func:`sequence_number_by_group` does it for the rows of hot groups only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from basketlab.functions.skew import split_by_groups
from basketlab.session import materialize


def sequence_number(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], name: str,
                    partitions: int | None = None, previous: dict[str, str] | None = None,
                    last: str | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of the row in its group by ``order_cols``.

    ``previous`` (new column -> column) adds values of the group's previous row
    (null for the first), ``last`` names a flag of the group's last row.  Both
    come from the slice; where a group goes on over partitions, from the table of
    shifts, which carries the end of the slice before.

    ``order_cols`` should make rows unique within a group (as for
    ``row_number``).  ``df`` is evaluated once for the range bounds and once
    for its rows, so it should be a scan or a written table.  The ranged rows
    are written once (partition ids must not change if a task is retried).
    """
    g = list(group_cols)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *g, *order_cols).withColumn("_pid", F.spark_partition_id())
    ranged = materialize(ranged, "sequence_ranged")
    previous = previous or {}
    by = Window.partitionBy("_pid", *g).orderBy(*order_cols)
    local = ranged.withColumns({"_local": F.row_number().over(by), "_ends": F.lead(F.lit(1)).over(by).isNull(),
                                **{new: F.lag(c).over(by) for new, c in previous.items()}})
    end = F.max(F.struct(*order_cols, F.struct(*previous.values()).alias("_of"))) if previous else F.lit(None).cast("int")
    counts = ranged.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_cnt"), end.alias("_end"))
    slices = Window.partitionBy(*g).orderBy("_pid")
    shifts = (counts.select(F.col("_pid").alias("_spid"), *[F.col(c).alias(f"_s_{c}") for c in g],
                            F.sum("_cnt").over(slices.rowsBetween(Window.unboundedPreceding, -1)).alias("_off"),
                            F.lag("_end").over(slices).alias("_before"),
                            F.lead(F.lit(True)).over(slices).alias("_goes_on"))
              .filter((F.col("_off") > 0) | F.col("_goes_on")))
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in g],
                  F.col("_pid") == F.col("_spid"))
    joined = local.join(F.broadcast(shifts), cond, "left")
    new = {name: (F.col("_local") + F.coalesce("_off", F.lit(0))).cast("int")}
    for column, of in previous.items():
        carried = F.col("_before")["_of"][of]
        new[column] = F.when(F.col("_local") > 1, F.col(column)).otherwise(carried)
    if last:
        new[last] = F.col("_ends") & F.col("_goes_on").isNull()
    return joined.withColumns(new).drop("_pid", "_local", "_ends", "_spid", "_off", "_before", "_goes_on",
                                        *[f"_s_{c}" for c in g])


def sequence_number_by_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], name: str, hot: Sequence[int],
                             previous: dict[str, str] | None = None, last: str | None = None) -> DataFrame:
    """:func:`sequence_number` with one shuffle by group, or none where ``df`` is already partitioned by it.

    ``hot`` are the groups too large for a task (:func:`basketlab.functions.skew.hot_groups`); they are numbered over ranges.
    """
    usual, large = split_by_groups(df, group_cols, hot)
    by = Window.partitionBy(*group_cols).orderBy(*order_cols)
    new = {name: F.row_number().over(by), **{c: F.lag(of).over(by) for c, of in (previous or {}).items()}}
    if last:
        new[last] = F.lead(F.lit(True)).over(by).isNull()
    out = usual.withColumns(new)
    if large is None:
        return out
    # read twice, for the bounds of the ranges and for the rows
    ranged = sequence_number(materialize(large, "sequence_large"), group_cols, order_cols, name, previous=previous, last=last)
    return out.unionByName(ranged.select(out.columns))
