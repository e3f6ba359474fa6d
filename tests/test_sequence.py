"""sequence_number equals row_number, also when one group spans many partitions."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from basketlab.functions.sequence import sequence_number
from conftest import rows


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3, None]), st.integers(0, 50)), min_size=1, max_size=60,
                unique=True),
       st.sampled_from([1, 3, 8]))
def test_sequence_number_matches_row_number(spark, data, parts):
    df = spark.createDataFrame([(g, o, i) for i, (g, o) in enumerate(data)], "g long, o long, i long")
    got = rows(sequence_number(df, ["g"], ["o"], "seq", partitions=parts), "i", "seq")
    want = rows(df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("o"))), "i", "seq")
    assert got == want
    w = Window.partitionBy("g").orderBy("o")
    got = rows(sequence_number(df, ["g"], ["o"], "seq", parts, previous={"before": "i", "gap": "o"}, last="end"),
               "i", "seq", "before", "gap", "end")
    want = rows(df.select("i", F.row_number().over(w).alias("seq"), F.lag("i").over(w).alias("before"), F.lag("o").over(w).alias("gap"),
                          F.lead("i").over(w).isNull().alias("end")), "i", "seq", "before", "gap", "end")
    assert got == want


def test_hot_group_spread(spark):
    df = spark.range(0, 5000).select(F.lit(7).alias("g"), (F.col("id") * 3).alias("o"))
    out = sequence_number(df, ["g"], ["o"], "seq", partitions=8)
    assert out.filter(F.col("seq") != F.col("o") / 3 + 1).count() == 0
    out = sequence_number(df, ["g"], ["o"], "seq", partitions=8, previous={"before": "o"}, last="end")
    assert out.filter("before = o - 3 AND seq > 1 OR before IS NULL AND seq = 1").count() == 5000
    assert [r.seq for r in out.filter("end").collect()] == [5000]


def test_running_total_distributed_path_matches_window(spark):
    """More distinct keys than the range sampler looks at, forced onto the distributed path."""
    from basketlab.functions.prefix import mid_ranks, running_total
    df = spark.range(0, 20000).select(((F.col("id") * 7919) % 20000).alias("k"), (F.col("id") % 5).alias("v"))
    got = running_total(df, ["k"], "v", "cum", partitions=8)
    want = df.withColumn("cum", F.sum("v").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.join(want.withColumnRenamed("cum", "w"), ["k", "v"]).filter("cum != w").count() == 0
    assert got.count() == 20000
    ties = spark.range(0, 3000).select((F.col("id") % 97).alias("x"))
    a = rows(mid_ranks(ties, "x", "r"), "x", "r")
    n = [3000 // 97 + (x < 3000 % 97) for x in range(97)]
    assert a == [(x, sum(n[:x]) + (n[x] + 1) / 2) for x in range(97)]


def test_orders_derivation(spark):
    """Against plain windows over each user; orders without a user keep their rows."""
    from basketlab.sources import testdata as TD
    raw = TD.read_table(spark, "/root/testdata/sf0.001", "orders")
    extra = raw.limit(3).withColumn("o_custkey", F.lit(None).cast("long")).withColumn("o_orderkey", F.col("o_orderkey") + 10 ** 9)
    raw = raw.unionByName(extra)
    got = TD.orders_from_tpch(raw)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    want = raw.select(F.col("o_orderkey").alias("order_id"), F.row_number().over(w).alias("order_number"),
                      (F.datediff(F.to_date("o_orderdate"), F.to_date(F.lag("o_orderdate").over(w))) % 31).cast("int").alias("gap"),
                      (F.count("*").over(Window.partitionBy("o_custkey")) == F.row_number().over(w)).alias("last"))
    assert got.count() == raw.count()
    mine = got.select("order_id", "order_number", F.col("days_since_prior_order").alias("gap"), (F.col("eval_set") != "prior").alias("last"))
    assert mine.exceptAll(want).count() == 0


def test_cart_positions(spark):
    from basketlab.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    _, _, _, part_map = TD.products_from_part(TD.read_table(spark, sf, "part"))
    got = TD.order_lines_from_tpch(TD.read_table(spark, sf, "lineitem"), part_map, TD.orders_from_tpch(TD.read_table(spark, sf, "orders")))
    spans = got.groupBy("order_id").agg(F.count("*").alias("n"), F.min("add_to_cart_order").alias("a"),
                                        F.max("add_to_cart_order").alias("z"), F.count_distinct("add_to_cart_order").alias("d"))
    assert spans.count() > 0 and spans.filter("a <> 1 OR z <> n OR d <> n").count() == 0
