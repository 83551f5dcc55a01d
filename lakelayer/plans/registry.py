"""Name -> (query, oracle SQL) registry used by ``__spark_entry__``.

A query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the input
tables of ``sf_dir`` and applies library operators.  The oracle is an
independent DuckDB SQL statement over the same tables (registered as views);
queries whose result cannot be written in SQL register no oracle.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PLAN_MODULES = (
    "churn",
    "cleaning",
    "features",
    "tables",
    "quality",
    "sections",
    "reports",
    "manifest",
    "profiling",
    "evaluation",
    "monitoring",
    "streams",
    "scalars",
    "models",
)


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for mod in PLAN_MODULES:
        importlib.import_module(f"lakelayer.plans.{mod}")
    return dict(QUERIES), dict(ORACLES)
