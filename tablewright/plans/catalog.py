"""All registered queries: key -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

import importlib
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

MODULES = ("hr", "company", "retail", "notebook", "ledger", "sources")


@lru_cache(maxsize=1)
def all_queries() -> dict:
    out: dict = {}
    for name in MODULES:
        mod = importlib.import_module(f"tablewright.plans.{name}")
        for key, value in mod.queries().items():
            if key in out:
                raise ValueError(f"duplicate query key {key}")
            out[key] = value
    return out


def build(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return all_queries()[key][0](spark, sf_dir)
