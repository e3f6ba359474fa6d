"""Driver contract and Spark ML save / load."""

import os
import tempfile

import pytest
from pyspark.ml import PipelineModel

import __spark_entry__ as entry_mod
from basketlab.operators import ml as ML


def test_contract_keys():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80 and len(o) >= 70


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert len(df.columns) == 37
    assert df.count() > 0


def test_model_save_load_predict(spark):
    rows = [(i, i % 7, float(i % 5), float(i % 3), int(i % 5 > 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, a double, b double, reordered int")
    feats = ML.feature_columns(df)
    assert feats == ["a", "b"]
    model = ML.fit(df, ML.PRESETS["gbt"](5), feats)
    d = tempfile.mkdtemp(prefix="basketlab-model-")
    model.write().overwrite().save(os.path.join(d, "m"))
    back = PipelineModel.load(os.path.join(d, "m"))
    s1 = ML.score(model, df, feats).orderBy("user_id").collect()
    s2 = ML.score(back, df, feats).orderBy("user_id").collect()
    assert s1 == s2
    m = ML.evaluate(ML.score(back, df, feats)).first()
    assert m.auc > 0.9


def test_model_trainer_interface(spark):
    rows = [(i, i % 7, float(i % 5), float(i % 3), int(i % 5 > 2)) for i in range(300)]
    train = spark.createDataFrame(rows, "user_id long, product_id long, a double, b double, reordered int")
    mt = ML.ModelTrainer("unit", train)
    model = mt.train_xgb_gbm("abc123", "1.2", "1.1.1", params={"rounds": 5, "min_child_weight": 1})
    rec = mt.last_run.first()
    assert rec.algorithm == "boosted" and rec.commit == "abc123" and rec.dataset_version == "1.2"
    assert 0.0 <= rec.auc <= 1.0 and rec.training_seconds > 0
    assert ML.trees_built(model) == 5 and not rec.stopped_on_test
    mt.train_h2o_glm("abc123", "1.2", "1.1.1")
    assert spark.read.parquet(mt.runs_path).count() == 2


def test_model_trainer_early_stopping_on_test_set(spark):
    rows = [(i, i % 7, float(i % 5), float(i % 3), int(i % 5 > 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, a double, b double, reordered int")
    train, test = df.filter("user_id % 4 != 0"), df.filter("user_id % 4 = 0")
    mt = ML.ModelTrainer("unit_es", train, test)
    model = mt.train_h2o_gbm("c0ffee", "1.2", "1.1.1", params={"rounds": 40})
    assert 1 <= ML.trees_built(model) <= 40
    assert mt.last_run.first().auc > 0.9


def test_parameters_are_mapped_or_rejected():
    p = ML.booster_preset(params={"rounds": 7, "lambda": 3, "verbose": 1})
    assert (p.params["rounds"], p.params["gamma"], p.params["lambda_"], p.params["alpha"], p.params["colsample_bylevel"]) == (7, 438, 3, 89, 0.118177830385349)
    assert p.unmapped == {"objective": "binary:logistic", "verbose": 1}
    glm = ML.with_params(ML.PRESETS["glm"](), {"lambda": 0.2, "alpha": 0.9}, ML.LINEAR_NAMES)
    assert (glm.params["regParam"], glm.params["elasticNetParam"]) == (0.2, 0.9)
    leaf = ML.boosted_preset("leaf_wise", {"num_leaves": 15, "learning_rate": 0.2, "max_depth": -1}, ML.LEAF_WISE_NAMES, **ML.LEAF_WISE_DEFAULTS)
    assert (leaf.params["max_leaves"], leaf.params["eta"], leaf.params["max_depth"], leaf.params["growth"], leaf.params["rounds"]) == (15, 0.2, 0, "leaf", 500)
    for names in (ML.BOOSTER_NAMES, ML.LEAF_WISE_NAMES, ML.MACHINE_NAMES):
        with pytest.raises(ValueError, match="bogus"):
            ML.boosted_preset("boosted", {"bogus": 1}, names)
    with pytest.raises(ValueError, match="bogus"):
        ML.with_params(ML.PRESETS["glm"](), {"bogus": 1}, ML.LINEAR_NAMES)


def test_early_stopping_and_run_record(spark):
    rows = [(i, i % 7, float(i % 5), float((i * 37) % 11), int((i % 5 > 2) ^ (i % 13 == 0))) for i in range(300)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, a double, b double, reordered int")
    train, test = df.filter("user_id % 3 <> 0"), df.filter("user_id % 3 = 0")
    t = ML.ModelTrainer("exp", train, test)
    model = t.train_h2o_gbm(prev_commit_hash="abc", dataset_version="1", model_version="2",
                            params={"ntrees": 60, "learn_rate": 0.8, "stopping_rounds": 2, "stopping_metric": "logloss"})
    assert len(model.losses) == min(60, model.best + 2) and ML.trees_built(model) == len(model.losses)
    r = t.last_run.first()
    assert (r.experiment, r.commit, r.stopped_on_test) == ("exp", "abc", True) and "stopping_metric" in r.unmapped_params
    imp = {r.feature: r for r in ML.feature_importance(spark, model, ["a", "b"]).collect()}
    assert imp["a"].total_gain > imp["b"].total_gain >= 0
    alone = ML.ModelTrainer("exp", train)  # the train set stands in for the test set
    model = alone.train_lgbm("abc", "1", "2", params={"rounds": 4, "early_stopping_rounds": 1, "min_data_in_leaf": 5, "num_leaves": 4})
    assert 1 <= len(model.losses) <= 4 and not alone.last_run.first().stopped_on_test
    forest = alone.train_xgb_rf("abc", "1", "2", params={"rounds": 2, "num_parallel_tree": 3, "subsample": 0.7})
    assert ML.trees_built(forest) == 6


def test_continued_training_reports_each_fold(spark):
    rows = [(i, i % 7, float(i % 5), float((i * 37) % 11), int((i % 5 > 2) ^ (i % 13 == 0))) for i in range(300)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, a double, b double, reordered int")
    models, report = ML.continued(df.filter("product_id < 6"), df.filter("product_id = 6"), ML.BO.Params(rounds=4, max_depth=2, patience=2))
    r = report.orderBy("fold").collect()
    assert [x.trees_built for x in r] == sorted(x.trees_built for x in r) and r[0].loss_before is None
    assert [x.loss_before for x in r[1:]] == [x.loss_after for x in r[:-1]] and len(models) == 3


@pytest.mark.parametrize("gone", [("corpus_pipeline",), ("basketlab.llm",), ("corpus_pipeline", "basketlab.llm"), ("public_tokenizers",)])
def test_entry_without_the_optional_part(gone):
    import subprocess
    import sys
    code = f"""
import sys, importlib.abc
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name in {gone!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) >= 90 and not [k for k in e.queries() if k.startswith("op") or k == "pipeline"]
assert set(e.oracle_sql()) <= set(e.queries())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_rows_are_scored_once_for_all_metrics(spark):
    scored = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            scored.add(b.num_rows)
            yield b

    rows = [(i % 2, (i * 7 % 10) / 10) for i in range(50)]
    df = spark.createDataFrame(rows, "label int, score double").mapInArrow(run, "label int, score double")
    got = ML.evaluate(df).first()
    want = ML.MT.all_metrics(spark.createDataFrame(rows, "label int, score double"), "label", "score").first()
    assert got == want and scored.value == 50


def test_root_gains_deal_no_rows_and_hash_none(spark, monkeypatch):
    from basketlab.operators import boosting as B
    from pyspark.sql import DataFrame
    df = spark.createDataFrame([(float(i % 5), float(i % 3), i % 2) for i in range(60)], "a double, b double, reordered int")
    p = B.Params(max_bins=4, cuts="width", min_child_weight=0.0)
    seen, binned = [], B.binned
    monkeypatch.setattr(B, "binned", lambda *a: seen.append(binned(*a)) or seen[-1])
    monkeypatch.setattr(B, "blocks", lambda *a: pytest.fail("blocks are for many jobs"))
    got = {(r.feature, r.bin): (r.left_rows, r.left_g) for r in B.root_gains(df, ["a", "b"], p).collect()}
    assert got["a", 1] == (12, pytest.approx(12 * .5 - 6)) and got["b", 1] == (20, pytest.approx(20 * .5 - 10))
    assert "xxhash64" not in seen[0]._jdf.queryExecution().toString()
