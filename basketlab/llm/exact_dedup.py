"""Exact deduplication by two passes over a Bloom filter.

Pass 1 hashes every normalised text to ``HASHES`` positions of a bit array and
counts, with map-side partial aggregation, which positions were hit at least
twice.  Those positions, packed into 4 KB bitmaps by Spark, form the filter of
*possibly repeated* hashes.  Pass 2 tests each row against the filter: a row
with a position that was hit only once has no copy and passes straight
through; only the others shuffle and are grouped by the SHA-256 of the text.
The filter has no false negatives, so the result is exact at every filter
size; a filter too small for its input only lets more rows shuffle.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from basketlab.llm.common import id_and_text, written

HASHES = 3
PAGE_BITS = 4096 * 8  # bits of one bitmap made by bitmap_construct_agg


def normalised(text) -> "F.Column":
    """Runs of ASCII white space become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def filter_bits(rows: int, bits_per_row: int, max_filter_bytes: int) -> int:
    """Size of the bit array: a power of two of whole pages, within the bound."""
    bits = PAGE_BITS
    while bits < rows * bits_per_row and bits * 2 <= max_filter_bytes * 8:
        bits *= 2
    return bits


def repeated_positions(hashed: DataFrame, bits: int) -> bytearray:
    """Bit array of the positions that two or more rows hit (pass 1).

    ``hashed`` has the array column ``at``.  At most ``bits / 8`` bytes reach
    the driver, in pages of 4 KB.
    """
    twice = (hashed.select(F.explode("at").alias("pos")).groupBy("pos").agg(F.count(F.lit(1)).alias("n"))
             .filter("n >= 2"))
    pages = (twice.select(F.shiftright("pos", 15).alias("page"), (F.col("pos") % PAGE_BITS).alias("bit"))
             .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = bytearray(bits // 8)
    for r in pages.toLocalIterator():
        out[r.page * 4096:(r.page + 1) * 4096] = r.bits
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 24,
                max_filter_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``max_filter_bytes`` bounds the filter that is gathered on the driver and
    broadcast.  Defined cases: a null text counts as empty; an empty table
    gives an empty result; of equal texts the smallest id stays (null ids are
    larger than all others), rows that repeat that id all count as it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    bits = filter_bits(docs.count(), bits_per_row, max_filter_bytes)
    at = F.array(*[F.pmod(F.xxhash64("norm", F.lit(i)), F.lit(bits)) for i in range(HASHES)])
    seen = spark.sparkContext.broadcast(bytes(repeated_positions(rows.select(at.alias("at")), bits)))

    @F.pandas_udf("boolean")
    def possibly_repeated(at: pd.Series) -> pd.Series:
        import numpy as np
        page = np.frombuffer(seen.value, np.uint8)
        pos = np.stack(at.to_numpy()) if len(at) else np.zeros((0, HASHES), np.int64)
        return pd.Series(((page[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).all(axis=1))

    marked = written(rows.select("doc_id", F.unhex(F.sha2(F.col("norm"), 256)).alias("sha"), at.alias("at"))
                     .select("doc_id", "sha", possibly_repeated("at").alias("maybe")), "exact_dedup")
    maybe = marked.filter("maybe").select("doc_id", "sha")
    groups = maybe.groupBy(F.col("sha").alias("of")).agg(F.min("doc_id").alias("keep_id"),
                                                         F.count(F.lit(1)).alias("group_size"))
    grouped = (maybe.join(groups, F.col("sha") == F.col("of"))
               .select("doc_id", "keep_id", "group_size", "sha"))
    single = marked.filter(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"),
                                                   F.lit(1).cast("long").alias("group_size"), "sha")
    return single.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
