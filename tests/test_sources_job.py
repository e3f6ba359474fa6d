"""Sources, sinks, configuration, casts and the batch job."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.schemas import cast_bulk, cast_by_type, require_columns
from basketlab.sources.config import JobConfig
from basketlab.sources.csv import read_matrix, read_source
from basketlab.sources.sinks import write_table
from basketlab.sources.testdata import load_testdata
from conftest import SF_SMALL


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "user_id long, x long")
    require_columns(df, "user_id")
    with pytest.raises(ValueError, match="product_id"):
        require_columns(df, "user_id", "product_id")


def test_cast_helpers(spark):
    df = spark.createDataFrame([(1, 2, "3.5", "")], "user_id long, n long, s string, e string")
    out = cast_by_type(df, T.LongType, T.DoubleType())
    assert dict(out.dtypes) == {"user_id": "bigint", "n": "double", "s": "string", "e": "string"}
    out = cast_by_type(df, T.StringType, T.DoubleType(), safe=True)
    assert out.select("s", "e").first() == (3.5, None)
    assert cast_bulk(df, "double", except_cols=["e"]).dtypes[0] == ("user_id", "double")


def test_job_config_requires_paths():
    with pytest.raises(ValueError, match="ORDERS_FILE_PATH"):
        JobConfig.from_args(["--output", "/x"], env={})
    env = {"ORDERS_FILE_PATH": "o", "PRIOR_PRODUCT_ORDERS_FILE_PATH": "p",
           "PRODUCTS_FILE_PATH": "pr", "TRAIN_PRODUCT_ORDERS_FILE_PATH": "t"}
    cfg = JobConfig.from_args(["--output", "/x", "--orders", "o2"], env=env)
    assert (cfg.orders, cfg.prior, cfg.output) == ("o2", "p", "/x")


def test_csv_reader_uses_declared_schema(spark):
    d = tempfile.mkdtemp(prefix="basketlab-test-")
    p = os.path.join(d, "orders.csv")
    with open(p, "w") as f:
        f.write("order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n")
        f.write("16777217,1,prior,1,2,8,\n")
    df = read_source(spark, "orders", p)
    r = df.first()
    assert r.order_id == 16777217 and r.days_since_prior_order is None  # 64-bit id survives
    assert dict(df.dtypes)["order_id"] == "bigint"


def write_csv(text):
    p = os.path.join(tempfile.mkdtemp(prefix="basketlab-test-"), "f.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_columns_by_name_and_decimal_text(spark):
    p = write_csv("product_id,extra,order_id,reordered,add_to_cart_order\n7,x,1000,1.0,08\n,y,16777217, 0 ,15.0\n")
    got = sorted(tuple(r) for r in read_source(spark, "order_products__prior", p).select(
        "order_id", F.coalesce("product_id", F.lit(-1)), "add_to_cart_order", "reordered").collect())
    assert got == [(1000, 7, 8, 1), (16777217, -1, 15, 0)]


@pytest.mark.parametrize("bad", ["12x", "1.5", "--"])
def test_csv_malformed_number_fails(spark, bad):
    p = write_csv(f"order_id,product_id,add_to_cart_order,reordered\n1,2,{bad},0\n")
    with pytest.raises(Exception, match="not an integer"):
        read_source(spark, "order_products__prior", p).collect()


def test_csv_missing_column(spark):
    p = write_csv("order_id,product_id,reordered\n1,2,0\n")
    with pytest.raises(ValueError, match="add_to_cart_order"):
        read_source(spark, "order_products__prior", p)


def test_scratch_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from basketlab.session import checkpoint_dir
    seen = []
    fake = SimpleNamespace(sparkContext=SimpleNamespace(
        master="spark://h:7077", getCheckpointDir=lambda: seen[-1] if seen else None, setCheckpointDir=seen.append,
        getConf=lambda: SimpleNamespace(get=lambda k, d: d)))
    with pytest.raises(ValueError, match="scratch"):
        checkpoint_dir(fake)
    assert checkpoint_dir(fake, "/shared/out/_scratch") == "/shared/out/_scratch"
    cfg = JobConfig.from_args(["--output", "/x", "--orders", "o", "--prior", "p", "--train", "t", "--products", "pr",
                               "--scratch", "/s", "--keywords", "red, cold"], env={})
    assert (cfg.scratch, cfg.keywords) == ("/s", ("red", "cold"))


def test_union_is_by_name(spark):
    t = load_testdata(spark, SF_SMALL)
    swapped = t.train_lines.select("reordered", "add_to_cart_order", "product_id", "order_id")
    from basketlab.sources.tables import BasketTables
    t2 = BasketTables(t.orders, t.prior_lines, swapped, t.products, t.aisles, t.departments)
    assert t2.history_lines().exceptAll(t.history_lines()).count() == 0


def test_csv_sink_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="basketlab-test-")
    df = spark.createDataFrame([(1, 2.5, None), (2, None, "x")], "user_id long, f double, s string")
    write_table(df, os.path.join(d, "m"), "csv")
    back = read_matrix(spark, os.path.join(d, "m"), "csv", label="f")
    assert back.schema == df.schema
    assert sorted(back.collect()) == sorted(df.collect())


def test_job_end_to_end(spark):
    """Write the sf0.001 star schema as CSV, run the job, check matrix sizes."""
    from basketlab.plans import matrices as M
    from basketlab.plans.job import main
    t = load_testdata(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="basketlab-job-")
    paths = {}
    for name, df in (("orders", t.orders), ("prior", t.prior_lines), ("train", t.train_lines),
                     ("products", t.products)):
        paths[name] = os.path.join(d, "in", name)
        df.write.option("header", True).csv(paths[name])
    out = os.path.join(d, "out")
    written = main([f"--{k}={v}" for k, v in paths.items()] + [f"--output={out}"])
    train = spark.read.parquet(written["train_matrix"])
    test = spark.read.parquet(written["test_matrix"])
    assert train.count() == t.history_lines().count()
    assert test.count() == M.test_candidates(t).count()
    assert len(train.columns) == 37 and len(test.columns) == 36
    assert set(test.columns) <= set(train.columns)
