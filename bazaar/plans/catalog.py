"""All registered queries: id -> Spark callable (spark, sf_dir) and id -> DuckDB oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# registry modules, each exposing SPARK (and optionally ORACLE) dicts
_MODULES = ["named", "derived_q", "eda_q", "etl_q", "features_q", "baskets_q", "experiments_q", "streaming_q", "models_q",
            "loading_q", "churn_q", "pricing_q", "quality_q"]


def _load():
    spark_q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    oracle: dict[str, str] = {}
    for m in _MODULES:
        mod = importlib.import_module(f"{__package__}.{m}")
        dup = set(spark_q) & set(mod.SPARK)
        if dup:
            raise ValueError(f"duplicate query ids {sorted(dup)}")
        spark_q.update(mod.SPARK)
        oracle.update(mod.ORACLE if hasattr(mod, "ORACLE") else {})
    missing = set(oracle) - set(spark_q)
    if missing:
        raise ValueError(f"oracle without query: {sorted(missing)}")
    return spark_q, oracle


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _load()[0]


def oracle_queries() -> dict[str, str]:
    return _load()[1]
