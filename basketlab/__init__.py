"""basketlab: next-basket analytics on Spark DataFrames.

Feature engineering (user / product / user x product / time), train and
test matrix assembly, exploratory statistics and Spark ML training for
"will this user reorder this product?" prediction.  Every operator is a
lazy DataFrame plan; nothing is collected to the driver.
"""

from basketlab.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
