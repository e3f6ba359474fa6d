"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a
text's shingles.  Sketches of parts merge to the sketch of the whole, and they
estimate resemblance (Jaccard likeness of the shingle sets), containment and
the number of distinct shingles.  Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlab.llm.common import id_and_text, written

K = 128
WORDS = 5  # words of a shingle
NEIGHBOURS = 6  # documents are dealt in blocks of 2 ** NEIGHBOURS consecutive ids
DIGITS = 16  # bits of an id that one window orders
TWO_63 = 2.0 ** 63


# ---------------------------------------------------------------- sketches
def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where a lambda refers to it for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all runs of ``words`` words; a shorter text is one shingle, a blank one none."""
    hashes = F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))

    def runs(h):
        starts = F.sequence(F.lit(1), F.greatest(F.size(h) - (words - 1), F.lit(1)))
        return F.when(F.size(h) > 0, F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, words)))).otherwise(
            F.array().cast("array<bigint>"))

    return let(hashes, runs)


def bottom_k(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Sketch of a text."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches were made of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's sketch that is in both; 1 for two empty sketches."""
    return let(merged(a, b, k), lambda union: F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from the k-th smallest hash."""
    kth = F.element_at(a, -1).cast("double")
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / ((kth + TWO_63) / (2 * TWO_63)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too (0 for an empty a)."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def to_text(a: Column) -> Column:
    """The hashes as 16 hexadecimal digits each."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def merge_sketches(parts: DataFrame, keys: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group: the k smallest distinct hashes of the group's sketches.

    Hashes are made distinct before they are ranked, in a fold that holds at
    most k hashes per group and task.
    """
    first = F.array().cast("array<bigint>")
    salted = parts.withColumn("salt_", F.pmod(F.xxhash64(sketch_col), F.lit(64)))
    fold = lambda c: F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_set(c)))), 1, k)
    return (salted.groupBy(*keys, "salt_").agg(fold(F.coalesce(F.col(sketch_col), first)).alias("part_"))
            .groupBy(*keys).agg(fold("part_").alias(sketch_col)))


# ---------------------------------------------------------------- neighbours
def successors(ids: DataFrame, bits: int) -> DataFrame:
    """``id, next_id`` for a table of distinct ``id``: the next larger one, null for the last.

    Ids are ordered within groups that share all but the last ``DIGITS`` bits,
    so no window holds more than 2 ** DIGITS rows; the last of a group is
    followed by the first of the next group, found the same way.
    """
    own = Window.partitionBy("group").orderBy("id")
    inner = ids.withColumn("group", F.shiftright("id", DIGITS)).withColumn("within", F.lead("id").over(own))
    if bits <= DIGITS:  # a group's number is 0 or -1 now: two groups at most
        heads = ids.agg(F.min(F.when(F.col("id") >= 0, F.col("id"))).alias("head")).select(
            F.lit(-1).cast("long").alias("before"), "head")
    else:
        heads = ids.groupBy(F.shiftright("id", DIGITS).alias("id")).agg(F.min("id").alias("head"))
        after = successors(heads.select("id"), bits - DIGITS)
        heads = (after.filter("next_id IS NOT NULL").join(heads.withColumnRenamed("id", "of"), F.col("next_id") == F.col("of"))
                 .select(F.col("id").alias("before"), "head"))
    return inner.join(heads, F.col("group") == F.col("before"), "left").select(
        "id", F.coalesce("within", "head").alias("next_id"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                 words: int = WORDS) -> DataFrame:
    """One row per document: its sketch, and those of its edited text and of the next document.

    ``doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited,
    near_next``.  The edited text has the last half of the code points
    replaced by the first as many of the next document (by id; after the last
    comes the first).  Defined cases: a null text counts as empty; blank texts
    have empty sketches, which are alike; rows that repeat an id follow each
    other in the order of their texts; a row with a null id has no next
    document (an empty text); an empty table gives no rows.

    Texts shuffle once, in blocks of neighbouring ids; only the first text of
    each block is needed elsewhere, by the last row of the block before.
    """
    rows = id_and_text(docs, id_col, text_col)
    known = rows.filter("doc_id IS NOT NULL").withColumn("block", F.shiftright("doc_id", NEIGHBOURS))
    firsts = written(known.groupBy("block").agg(F.min(F.struct("doc_id", "text")).alias("first"))
                     .select("block", F.col("first.text").alias("first_text")), "firsts")
    after = successors(firsts.select(F.col("block").alias("id")), 64 - NEIGHBOURS)
    start = firsts.select(F.min("block")).scalar()
    follow = (after.select(F.col("id").alias("of_block"), F.coalesce(F.col("next_id"), start).alias("next_block"))
              .join(firsts, F.col("next_block") == F.col("block"))
              .select("of_block", "first_text", bottom_k(F.col("first_text"), k, words).alias("first_sketch")))
    order = Window.partitionBy("block").orderBy("doc_id", "text")
    blocks = known.repartition("block").withColumn("sketch", bottom_k(F.col("text"), k, words))
    pairs = (blocks.select("block", "doc_id", "text", "sketch", F.lead("text").over(order).alias("lead_text"),
                           F.lead("sketch").over(order).alias("lead_sketch"))
             .join(follow, F.col("block") == F.col("of_block"))
             .select("doc_id", "text", "sketch", F.coalesce("lead_text", "first_text").alias("next_text"),
                     F.coalesce("lead_sketch", "first_sketch").alias("next_sketch")))
    alone = rows.filter("doc_id IS NULL").select(
        "doc_id", "text", bottom_k(F.col("text"), k, words).alias("sketch"), F.lit("").alias("next_text"),
        F.array().cast("array<bigint>").alias("next_sketch"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = pairs.unionByName(alone).withColumn("edited", F.concat(
        F.col("text").substr(F.lit(1), F.length("text") - half), F.col("next_text").substr(F.lit(1), half)))
    return edited.withColumn("edited_sketch", bottom_k(F.col("edited"), k, words)).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "sketch", "edited_sketch", resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
