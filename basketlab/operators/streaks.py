"""Purchase streaks of a product within a user's order sequence.

Streak lengths come from a mergeable state instead of ordered rows.  The order
numbers of a (user, product) are cut into chunks of 64.  Per chunk an
aggregate with map-side combination counts the rows of every number; it
becomes one bit per number, with the counts of those numbers only that occur
in several rows.  A second aggregate puts a pair's chunks into one row: 64
numbers in a few bytes, at most the range of the INT order numbers.  Runs
and groups are then read off that row, so a plan has these two exchanges and
no join; NULL users and products are groups like any other.

Order of the rows of a (user, product): by order number, NULL first; rows with
the same number by ``order_id``, so only the last of them can be followed by
the next number.  A row is *flagged* if the next row's number is one larger.

Two grouping modes:

* ``compat``: the group of a row is the number of earlier rows of its (user,
  product) with the *other* run flag; lengths ignore the flag.  It breaks a
  run before its last order and merges non-consecutive purchases
  (1,2,3,4 -> {1,3}).
* ``island``: the true consecutive-run ("gaps and islands") length: the group
  is the order number minus the row's position (1,2,3,4 -> {4}; 1,3,5 -> {1,1,1}).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from basketlab.schemas import cast_by_type

STREAK_MODES = ("compat", "island")
CHUNK = 64  # order numbers of one bitmap
BUCKET_ROWS = 4096  # order numbers of one window partition of the flags
WHOLE_ROWS = 1024  # rows of a pair that are unfolded in place
PAIR = ("user_id", "product_id")


def streak_flags(df: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Next order number of the same (user, product) and the run flag.

    The rows meet in buckets of ``bucket_rows`` order numbers.  The last row of
    a bucket is followed by the first number of the pair's next bucket, which a table of the
    pairs with several buckets knows.
    """
    v = F.col("order_number")
    # a struct is never NULL itself, so NULL users, products and numbers match in the join
    rows = df.select(*PAIR, "order_id", "order_number",
                     F.struct(*PAIR, F.floor(v / bucket_rows).cast("long").alias("b")).alias("bucket"))
    firsts = (rows.groupBy("bucket").agg(F.min("order_number").alias("first"))
              .groupBy("bucket.user_id", "bucket.product_id").agg(F.array_sort(F.collect_list(F.struct(F.col("bucket.b").alias("b"), "first"))).alias("all")))
    # array_sort puts a bucket without a number (b NULL) first, as its rows come first
    behind = (firsts.filter(F.size("all") > 1)
              .select(*PAIR, "all", F.explode(F.sequence(F.lit(0), F.size("all") - 2)).alias("i"))
              .select(F.struct(*PAIR, F.col("all")[F.col("i")]["b"].alias("b")).alias("of"), F.col("all")[F.col("i") + 1]["first"].alias("first_behind")))
    w = Window.partitionBy("bucket").orderBy("order_number", "order_id")
    return (rows.withColumn("next", F.lead("order_number").over(w)).withColumn("last", F.lead(F.lit(True)).over(w).isNull())
            .join(behind, F.col("bucket") == F.col("of"), "left")
            .withColumn("next_order_number", F.when(F.col("last"), F.col("first_behind")).otherwise(F.col("next")))
            .select(*PAIR, "order_id", "order_number", "next_order_number",
                    F.when(F.col("next_order_number") - v == 1, 1).otherwise(0).alias("is_streak_continued_flag")))


# ---------------------------------------------------------------- state
def order_number_state(df: DataFrame) -> DataFrame:
    """One row per (user, product): ``blanks`` rows without an order number, ``numbered`` others, and
    their sorted ``chunks`` (``c``, ``bits``, ``more``): bit k stands for the number 64 c + k,
    ``more`` has the (offset, rows) of numbers in several rows, NULL if there are none.
    """
    v = F.col("order_number").cast("long")
    # at most CHUNK distinct offsets in as many bins: the histogram is exact; equal bins of merged parts may stand side by side
    counted = (df.groupBy(*PAIR, F.floor(v / CHUNK).cast("long").alias("c"))
               .agg(F.histogram_numeric(F.pmod(v, F.lit(CHUNK)), F.lit(CHUNK)).alias("h"), F.count(F.lit(1)).alias("n"),
                    F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(order_number, {CHUNK}) as int))")).alias("bits")))
    offsets = F.array_distinct(F.transform("h", lambda b: b["x"].cast("int")))
    rows_at = F.transform(offsets, lambda k: F.struct(k.alias("k"), F.aggregate(
        F.filter("h", lambda b: b["x"].cast("int") == k), F.lit(0.0), lambda s, b: s + b["y"]).cast("long").alias("n")))
    more = F.when(F.col("n") > F.bit_count("bits"), F.filter(rows_at, lambda x: x["n"] > 1))
    chunk = F.when(F.col("c").isNotNull(), F.struct("c", "bits", more.alias("more")))
    # a number of partitions that is asked for isn't merged: a chunk of a few bytes unfolds into as many as 64 groups, so
    # partitions merged by their bytes would make a task's hash table grow with the input
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (counted.select(*PAIR, chunk.alias("chunk"), F.when(F.col("c").isNull(), F.col("n")).otherwise(0).alias("blank"), "n")
            .repartition(n, *PAIR).groupBy(*PAIR).agg(F.sum("blank").alias("blanks"), F.sum(F.col("n") - F.col("blank")).alias("numbered"),
                                F.array_sort(F.collect_list("chunk")).alias("chunks")))


def numbers_of(chunk):
    """The order numbers of a chunk, ascending."""
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda k: F.getbit(chunk["bits"], k) == 1)
    return F.transform(set_bits, lambda k: chunk["c"] * CHUNK + k)


def rows_of_number(chunk, number):
    """In how many rows a number of the chunk occurs."""
    own = F.filter(chunk["more"], lambda x: x["k"] == F.pmod(number, F.lit(CHUNK)))
    return F.coalesce(F.get(own, F.lit(0))["n"], F.lit(1).cast("long"))


def _groups_in_place(state: DataFrame, mode: str) -> DataFrame:
    """Groups of pairs whose rows all stand in one array: from the runs in the array of numbers.

    A number in several rows stands there as often; each such row but the last ends a run.
    """
    def repeated(chunk):
        v = numbers_of(chunk)
        return F.when(chunk["more"].isNull(), v).otherwise(F.flatten(F.transform(v, lambda x: F.array_repeat(x, rows_of_number(chunk, x).cast("int")))))

    numbers = state.withColumn("v", F.flatten(F.transform("chunks", repeated))).withColumn("m", F.size("v"))
    # the places behind the last rows of the runs
    ends = F.filter(F.sequence(F.lit(1), F.greatest("m", F.lit(1))), lambda i: (i == F.col("m")) | (F.get("v", i) - F.get("v", i - 1) != 1))

    def run(end, r):
        start = F.when(r == 0, 0).otherwise(F.get("ends", r - 1))
        return F.struct(r.alias("r"), end.alias("end"), (end - start).alias("size"), F.get("v", start).alias("first"))

    def groups(x):
        if mode == "island":
            return F.array(F.struct((x["first"] - F.col("blanks") - (x["end"] - x["size"]) - 1).alias("grp"), x["size"].cast("long").alias("n")))
        # a run of s rows: its last one isn't flagged and stands behind end - 1 - r flagged ones; the others are, behind the
        # last rows of r runs and the blanks
        last = F.struct((x["end"] - 1 - x["r"]).cast("long").alias("grp"), F.lit(1).cast("long").alias("n"))
        rest = F.struct((F.col("blanks") + x["r"]).alias("grp"), (x["size"] - 1).cast("long").alias("n"))
        return F.when(x["size"] > 1, F.array(last, rest)).otherwise(F.array(last))

    found = F.flatten(F.transform(F.transform("ends", run), groups))
    # the rows without a number are a group that adds no length
    blank = F.struct(F.lit(0 if mode == "compat" else None).cast("long").alias("grp"), F.lit(0).cast("long").alias("n"))
    own = F.concat(F.when(F.col("m") > 0, found).otherwise(F.array()), F.when(F.col("blanks") > 0, F.array(blank)).otherwise(F.array()))
    return numbers.withColumn("ends", ends).select(*PAIR, F.inline(own))


def _groups_as_rows(state: DataFrame, mode: str) -> DataFrame:
    """Groups of pairs with many rows: the numbers become rows, which running totals walk through.

    The pairs keep their partition, so nothing is exchanged; a running total holds one row at a time.
    """
    def with_next(chunk, i):
        follows = F.get("chunks", i + 1)
        return F.struct(chunk["c"].alias("c"), chunk["bits"].alias("bits"), chunk["more"].alias("more"),
                        F.when(follows["bits"].isNotNull(), F.get(numbers_of(follows), F.lit(0))).alias("behind"))

    chunk = (state.select(*PAIR, "blanks", F.explode(F.transform("chunks", with_next)).alias("chunk"))
             .withColumn("v", numbers_of(F.col("chunk"))))
    cells = (chunk.select(*PAIR, "blanks", "chunk", "v", F.posexplode("v").alias("i", "number"))
             .withColumn("next", F.coalesce(F.get("v", F.col("i") + 1), F.col("chunk.behind")))
             .select(*PAIR, "blanks", "number", F.when(F.col("next") - F.col("number") == 1, 1).otherwise(0).alias("flag"),
                     rows_of_number(F.col("chunk"), F.col("number")).alias("rows")))
    along = Window.partitionBy(*PAIR).orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    cells = (cells.withColumn("before", F.col("blanks") + F.coalesce(F.sum("rows").over(along), F.lit(0)))
             .withColumn("flags", F.coalesce(F.sum("flag").over(along), F.lit(0)).cast("long")))
    one = F.lit(1).cast("long")
    blank = F.struct(F.lit(0 if mode == "compat" else None).cast("long").alias("grp"), F.lit(0).cast("long").alias("n"))
    blanks = F.when((F.col("blanks") > 0) & F.col("first"), F.array(blank)).otherwise(F.array())
    if mode == "island":  # rows that share a number stand one behind the other, each a position further
        own = F.transform(F.sequence(one, F.col("rows")), lambda i: F.struct((F.col("number") - F.col("before") - i).alias("grp"), one.alias("n")))
    else:
        plain = F.struct(F.col("flags").alias("grp"), (F.col("rows") - F.col("flag")).alias("n"))
        flagged = F.struct((F.col("before") - F.col("flags") + F.col("rows") - 1).alias("grp"), one.alias("n"))
        own = F.when(F.col("flag") == 0, F.array(plain)).when(F.col("rows") == 1, F.array(flagged)).otherwise(F.array(plain, flagged))
    return cells.withColumn("first", F.col("before") == F.col("blanks")).select(*PAIR, F.inline(F.concat(own, blanks)))


def streak_lengths(df: DataFrame, mode: str = "compat", whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """(user_id, product_id, grp, length_of_streaks); rows without an order number add no length.

    Pairs of up to ``whole_rows`` rows are unfolded in place, the others as
    rows; both give the same groups.
    """
    if mode not in STREAK_MODES:
        raise ValueError(f"streak mode must be one of {STREAK_MODES}, got {mode!r}")
    state = order_number_state(df)
    small = F.col("numbered") <= whole_rows
    groups = _groups_in_place(state.filter(small), mode).unionByName(_groups_as_rows(state.filter(~small), mode))
    return (groups.withColumn("grp", F.col("grp").cast("int")).groupBy(*PAIR, "grp")
            .agg(F.sum("n").alias("length_of_streaks")))


def product_streak_stats(lengths: DataFrame) -> DataFrame:
    """P8-P11 in one aggregation (the reference runs four and joins them)."""
    n = F.col("length_of_streaks")

    def share(k: int):
        return (F.sum(F.when(n >= k, 1).otherwise(0)) / F.count(n)).alias(f"prob_of_reordered_{k}")

    return lengths.groupBy("product_id").agg(
        F.count("grp").alias("Total_streak_of_this_product"),
        F.avg(n).alias("mean_of_streaks_of_this_product"),
        F.min(n).alias("min_of_streaks_of_this_product"),
        F.max(n).alias("max_of_streaks_of_this_product"),
        share(5), share(3), share(2),
    )


def product_streak_features(lengths: DataFrame) -> DataFrame:
    return cast_by_type(product_streak_stats(lengths), T.LongType, T.DoubleType())
