"""Job configuration from arguments or environment variables (S3)."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass

from basketlab.operators.base import DEFAULT_KEYWORDS

ENV = {
    "orders": "ORDERS_FILE_PATH",
    "prior": "PRIOR_PRODUCT_ORDERS_FILE_PATH",
    "products": "PRODUCTS_FILE_PATH",
    "train": "TRAIN_PRODUCT_ORDERS_FILE_PATH",
}


@dataclass(frozen=True)
class JobConfig:
    orders: str
    prior: str
    train: str
    products: str
    output: str
    departments: str | None = None
    aisles: str | None = None
    output_format: str = "parquet"
    streak_mode: str = "compat"
    scratch: str | None = None
    keywords: tuple[str, ...] = DEFAULT_KEYWORDS

    @classmethod
    def from_args(cls, argv: list[str] | None = None, env: dict | None = None) -> JobConfig:
        """Arguments win over environment variables; missing inputs raise ``ValueError``."""
        env = os.environ if env is None else env
        ap = argparse.ArgumentParser(prog="basketlab-job")
        for k in ("orders", "prior", "train", "products", "departments", "aisles"):
            ap.add_argument(f"--{k}")
        ap.add_argument("--output", required=False)
        ap.add_argument("--format", dest="output_format", default="parquet", choices=["parquet", "csv"])
        ap.add_argument("--streak-mode", default="compat", choices=["compat", "island"])
        ap.add_argument("--scratch", help="shared folder of intermediate tables (default: OUTPUT/_scratch)")
        ap.add_argument("--keywords", help="comma-separated product-name keywords of the keyword feature")
        a = ap.parse_args(argv)
        vals = {k: getattr(a, k) or env.get(v) for k, v in ENV.items()}
        missing = [ENV[k] for k, v in vals.items() if not v]
        if missing:
            raise ValueError("missing input paths (set the arguments or environment variables): "
                             + ", ".join(missing))
        if not a.output:
            raise ValueError("missing --output path")
        keywords = tuple(k.strip() for k in a.keywords.split(",") if k.strip()) if a.keywords else DEFAULT_KEYWORDS
        return cls(output=a.output, scratch=a.scratch, keywords=keywords, departments=a.departments, aisles=a.aisles,
                   output_format=a.output_format, streak_mode=a.streak_mode, **vals)
