"""Joins on keys that may hold a large share of either side.

Adaptive execution can split a hot key only on a side that the join doesn't
have to preserve.  Here a mergeable heavy-hitter sketch of bounded size
(``freqItems``) names the keys that may hold ``support`` of a side's rows.  The rows of
such a key are dealt over ``salts`` tasks and the other side's rows of that key go to
all of them; all other keys are joined as usual.  Rows with a NULL key match nothing
and take part in no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 16
SUPPORT = 0.02
GROUP_SUPPORT = 0.005
GROUP_ROWS = 500_000  # rows of a group that one task takes


def key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in on])


def heavy_hitters(df: DataFrame, on: Sequence[str], support: float = SUPPORT) -> list[int]:
    """Hashes of all keys that hold ``support`` or more of the rows, at most ``1 / support`` of them or a few more.

    Keys with fewer rows may be among them, none that has as many is missing.
    """
    found = df.select(key_hash(on).alias("h")).freqItems(["h"], support).first()
    return sorted(found[0] or [])


def hot_groups(df: DataFrame, on: Sequence[str], most: int | None = None, support: float = GROUP_SUPPORT) -> list[int]:
    """Hashes of the groups that one task shouldn't take: of more than ``most`` (``GROUP_ROWS``) rows and ``support`` of all rows.

    A sketch of bounded size names those that may be, a second pass counts them; no row is
    shuffled.  NULL is a value like any other.  ``df`` is read twice, so it should be a scan.
    """
    found = heavy_hitters(df, on, support)
    if not found:
        return []
    counts = df.select(key_hash(on).alias("h")).filter(F.col("h").isin(found)).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return sorted(r.h for r in counts.filter(F.col("n") > (GROUP_ROWS if most is None else most)).collect())


def split_by_groups(df: DataFrame, on: Sequence[str], hot: Sequence[int]) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the other groups, and those of the groups in ``hot`` (None if there are no such groups)."""
    if not hot:
        return df, None
    own = key_hash(on).isin(list(hot))
    return df.filter(~own), df.filter(own)


def dealt(df: DataFrame, salts: int) -> DataFrame:
    """A salt per row: a hash of the row and of its partition, so that equal rows are spread too."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id()), F.lit(salts)).cast("int"))


def to_all(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", support: float = SUPPORT, salts: int = SALTS) -> DataFrame:
    """``left`` joined with ``right`` on equal columns; ``how`` is inner, left, right or full.

    Columns: ``on``, then the others of ``left`` and of ``right``, as with a join by name.
    """
    on = list(on)
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join type {how!r}")
    columns = [*on, *(c for c in left.columns if c not in on), *(c for c in right.columns if c not in on)]
    if how == "right":
        return skew_join(right, left, on, "left", support, salts).select(columns)
    present = F.lit(True)
    for c in on:
        present &= F.col(c).isNotNull()
    known_left, known_right = left.filter(present), right.filter(present)
    hot_left, hot_right = heavy_hitters(known_left, on, support), heavy_hitters(known_right, on, support)
    h = key_hash(on)

    def among(keys: list[int]) -> Column:
        return h.isin(keys) if keys else F.lit(False)

    by_right = among(hot_right)  # hot on the right, and perhaps on the left
    by_left = among(hot_left) & ~by_right
    usual = ~by_right & ~by_left
    one_sided = "inner" if how == "inner" else "left"
    parts = [known_left.filter(usual).join(known_right.filter(usual), on, one_sided).select(columns)]
    if set(hot_left) - set(hot_right):
        parts.append(dealt(known_left.filter(by_left), salts).join(to_all(known_right.filter(by_left), salts), [*on, "_salt"], one_sided).select(columns))
    if hot_right:
        a, b = known_left.filter(by_right), known_right.filter(by_right)
        parts.append(to_all(a, salts).join(dealt(b, salts), [*on, "_salt"]).select(columns))
        if how != "inner":  # a key of equal hash that isn't on the right
            parts.append(_with_nulls(a.join(b.select(on).distinct(), on, "left_anti"), right, columns))
    if how != "inner":
        parts.append(_with_nulls(left.filter(~present), right, columns))
    if how == "full":
        parts.append(_with_nulls(known_right.join(known_left.select(on).distinct(), on, "left_anti"), left, columns))
        parts.append(_with_nulls(right.filter(~present), left, columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _with_nulls(rows: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in other.schema.fields}
    return rows.select([F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns])
