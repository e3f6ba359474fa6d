"""Batch job: source CSVs -> feature tables -> train / test matrices.

    spark-submit --py-files basketlab.zip basketlab/plans/job.py --orders ... --prior ... \
        --train ... --products ... --output s3a://bucket/run/

The per-(order, product) table goes to the folder in ``spark.checkpoint.dir``,
or else ``--scratch``, by default ``_scratch`` below the output; the
three feature tables are written once under ``output/features`` and read
back, so both matrices reuse them and an executor lost during matrix
assembly re-reads files instead of recomputing the feature lineage.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Sequence

if __package__ in (None, ""):  # run as a script by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from basketlab.plans import matrices as M  # noqa: E402
from basketlab.plans.features import FeatureSet  # noqa: E402
from basketlab.operators.base import DEFAULT_KEYWORDS  # noqa: E402
from basketlab.session import checkpoint_dir, get_spark  # noqa: E402
from basketlab.sources.config import JobConfig  # noqa: E402
from basketlab.sources.csv import load_csv_tables  # noqa: E402
from basketlab.sources.sinks import write_table  # noqa: E402
from basketlab.sources.tables import BasketTables  # noqa: E402


def run(spark: SparkSession, t: BasketTables, output: str, fmt: str = "parquet",
        streak_mode: str = "compat", scratch: str | None = None,
        keywords: Sequence[str] = DEFAULT_KEYWORDS) -> dict[str, str]:
    out = output.rstrip("/")
    checkpoint_dir(spark, scratch or f"{out}/_scratch")
    fs = FeatureSet.from_tables(t, streak_mode=streak_mode, keywords=keywords, table_dir=f"{out}/features")
    user_f, prod_f, up_f = fs.feature_tables  # written once under output/features, read back
    written = {name: f"{out}/features/{name}"
               for name in ("user_features", "product_features", "user_product_features")}
    written["train_matrix"] = write_table(fs.train_matrix(), f"{out}/final_prior_train_set", fmt)
    test = M.test_matrix(user_f, prod_f, up_f, fs.orders, M.test_candidates(t))
    written["test_matrix"] = write_table(test, f"{out}/featured_test_set", fmt)
    return written


def main(argv: list[str] | None = None) -> dict[str, str]:
    cfg = JobConfig.from_args(argv)
    spark = get_spark("basketlab-features")
    t = load_csv_tables(spark, cfg.orders, cfg.prior, cfg.train, cfg.products, cfg.departments, cfg.aisles)
    return run(spark, t, cfg.output, cfg.output_format, cfg.streak_mode, cfg.scratch, cfg.keywords)


if __name__ == "__main__":
    main(sys.argv[1:])
