"""Queries of this package's operators over the test tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlab.llm.bpe import encode_decode
from basketlab.llm.common import read_table
from basketlab.llm.exact_dedup import exact_dedup
from basketlab.llm.extraction import extract_text
from basketlab.llm.minhash import near_duplicates
from basketlab.llm.packing import best_fit_packing
from basketlab.llm.periodic import periodic_runs, with_periodic_tails
from basketlab.llm.phrases import collocations
from basketlab.llm.quality import score_quality
from basketlab.llm.sketch import fingerprints, to_text
from basketlab.llm.suffix_dedup import remove_repeats
from basketlab.llm.token_counts import count_tokens
from basketlab.llm.toxicity import classify
from basketlab.llm.warc import archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text")


@query
def op1_extraction(spark, sf_dir):
    """Main text of every page."""
    return extract_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html")).withColumn(
        "n_chars", F.length("text").cast("long"))


@query
def op2_exact_dedup(spark, sf_dir):
    """Exact copies up to white space; one row per document."""
    return exact_dedup(documents(spark, sf_dir))


ORACLES["op2_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
     g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query
def op3_fingerprints(spark, sf_dir):
    """Bottom-k sketches of every document, of its edited text, and their likeness."""
    own = fingerprints(documents(spark, sf_dir))
    return own.select("doc_id", "n_chars", "edited_sha256", to_text(F.col("sketch")).alias("fingerprint"),
                      to_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op4_warc(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    return archive_round_trip(read_table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of every document, and what they decode to, as digests."""
    coded = encode_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_best_fit_packing(spark, sf_dir):
    """Token pieces of all documents packed into sequences of at most 4096 tokens."""
    return best_fit_packing(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_toxicity(spark, sf_dir):
    """Toxicity probabilities and decision of every document."""
    return classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op8_minhash(spark, sf_dir):
    """Class of near-duplicate documents of every document."""
    return near_duplicates(documents(spark, sf_dir))


@query
def op9_token_counts(spark, sf_dir):
    """Unigram token count of every document."""
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op10_suffix_dedup(spark, sf_dir):
    """Bytes of every document that repeat an earlier string of 100 bytes, removed."""
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every document, one in ten with a repeated stretch at its end."""
    found = periodic_runs(with_periodic_tails(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = F.col("strongest")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
                        best["length"].alias("length"), best["period"].alias("period"),
                        F.floor(F.lit(1000) * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_collocations(spark, sf_dir):
    """The best 2000 phrases of two or three words of every language."""
    return collocations(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


ORACLES["op12_collocations"] = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
     p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     slots AS (SELECT lang, w, len(w) AS words, unnest(range(1, len(w) + 1)) AS i FROM w),
     g AS (SELECT lang, w[i] AS phrase, 1 AS size FROM slots
           UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM slots WHERE i + 1 <= words
           UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM slots WHERE i + 2 <= words),
     f AS (SELECT lang, phrase, size, count(*) AS a FROM g GROUP BY ALL),
     n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
     c AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS w FROM f WHERE a >= 10 AND size > 1),
     cuts AS (SELECT lang, phrase, size, a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
              UNION ALL SELECT lang, phrase, size, a, 2, array_to_string(w[1:2], ' '), w[3] FROM c WHERE size = 3),
     scored AS (SELECT cuts.*, fx.a AS l, fy.a AS r,
                       ((1000000::HUGEINT * cuts.a * cuts.a) // (fx.a::HUGEINT * fy.a))::BIGINT AS score
                FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.phrase = x JOIN f fy ON fy.lang = cuts.lang AND fy.phrase = y),
     lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     inside AS (SELECT lang, part, max(a) AS most FROM (
                    SELECT lang, a, array_to_string(w[1:2], ' ') AS part FROM c WHERE size = 3
                    UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE size = 3) GROUP BY ALL),
     kept AS (SELECT b.* FROM lowest b LEFT JOIN inside i ON i.lang = b.lang AND i.part = b.phrase
              WHERE i.most IS NULL OR 100 * i.most < 50 * b.a),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM ranked r JOIN n USING (lang) WHERE r.rank <= 2000
"""


@query
def op13_quality(spark, sf_dir):
    """Quality of every document, learnt from the labels of two thirds of them."""
    return score_quality(documents(spark, sf_dir), read_table(spark, sf_dir, "labels", "doc_id", "quality"))
