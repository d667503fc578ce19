"""Registry of the siting queries and of the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must return the same rows."""

    def put(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries are called {name}")
        _QUERIES[name] = f
        if oracle:
            _ORACLES[name] = oracle
        return f

    return put


MODULES = ("supply_queries", "telemetry_queries", "spatial_queries", "misc_queries", "more_queries", "gate_queries", "entity_queries")


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"hexsite.plans.{m}")


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLES


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _QUERIES["q1_coverage_baseline"](spark, sf_dir)
