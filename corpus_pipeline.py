"""Corpus pipeline: the stages that turn raw documents into packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read back as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``; a stage's decision removes rows.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from basketlab.llm.common import read_table, written  # noqa: E402
from basketlab.llm.exact_dedup import exact_dedup, normalised  # noqa: E402
from basketlab.llm.minhash import near_duplicates  # noqa: E402
from basketlab.llm.packing import best_fit_packing  # noqa: E402
from basketlab.llm.suffix_dedup import remove_repeats  # noqa: E402
from basketlab.llm.toxicity import classify  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_rows(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """The rows whose key is among the ``key`` of ``kept``, with their own columns only.

    Keys hold a digest of the text beside the id, so rows that repeat an id are
    decided one by one, and rows without an id like all others; rows of equal
    id and text stay or go together.
    """
    rows = docs.select(*COLUMNS, key.alias("key"))
    return rows.join(kept.select("key").distinct(), "key", "left_semi").select(*COLUMNS)


def id_and_digest(text: Column) -> Column:
    """A struct is never null, so null ids match."""
    return F.struct(F.col("doc_id").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(key.alias("key"), "doc_id", "text")
    known = rows.select("key", "doc_id").join(labels, "doc_id").select(F.col("key").alias("doc_id"), "toxic")
    verdicts = classify(rows.select("key", "text"), known, id_col="key")
    return keep_rows(docs, key, verdicts.filter("NOT toxic").select(F.col("doc_id").alias("key")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    kept = exact_dedup(docs).filter("kept").select(F.struct("doc_id", "text_sha256").alias("key"))
    return keep_rows(docs, id_and_digest(normalised(F.col("text"))), kept)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    kept = near_duplicates(docs).filter("kept").select(F.struct("doc_id", "text_sha256").alias("key"))
    return keep_rows(docs, id_and_digest(F.coalesce("text", F.lit(""))), kept)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeat a string of 100 bytes of an earlier document leave the texts.

    A cut may fall inside a character; its other bytes go too.  Documents of
    which nothing but white space is left go; ``n_chars`` is counted anew
    where a text has changed; a null text comes out empty.
    """
    cut, changed = remove_repeats(docs, carry=[c for c in COLUMNS if c != "text"], as_text=True), F.col("n_removed") > 0
    return (cut.filter(~changed | F.col("kept").rlike(r"\S"))
            .select("row.*", F.col("kept").alias("text"), changed.alias("changed"))
            .withColumn("n_chars", F.when(F.col("changed"), F.length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece."""
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("minhash", near_stage),
    ("suffix_dedup", repeats_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # trained models, tokenizers and similarity estimates have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents", *COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
