"""Registered queries: ``(spark, sf_dir) -> DataFrame`` plus DuckDB oracle SQL."""

from __future__ import annotations

import importlib

from souk.plans.registry import ORACLES, QUERIES

_MODULES = ["sources", "scalar", "joins", "aggregates", "windows", "sessions", "incremental", "quality", "streams", "score", "series"]


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"souk.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"souk.plans.{m}":
                raise


load_all()

__all__ = ["QUERIES", "ORACLES"]
