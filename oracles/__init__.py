"""DuckDB oracle SQL for the registered queries (same keys as the registry)."""

from oracles.eda_sql import ORACLES as _EDA
from oracles.features_sql import ORACLES as _FEATURES
from oracles.model_sql import ORACLES as _MODEL

ORACLES: dict[str, str] = {}
for _part in (_FEATURES, _EDA, _MODEL):
    ORACLES.update(_part)
