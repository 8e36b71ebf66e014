"""Name -> (Spark job, DuckDB oracle SQL) registry.

Every plan module decorates its ``(spark, sf_dir) -> DataFrame`` callables
with :func:`query`; the oracle text is optional (omitted only for results
SQL cannot express, which then get inline pytest expectations instead).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
