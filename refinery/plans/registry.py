"""Name → (Spark plan builder, oracle SQL)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is DuckDB SQL over the same tables (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def attach(oracles: dict[str, str]) -> None:
    """Attach oracle SQL written next to the plans (kept apart for readability)."""
    for k, v in oracles.items():
        if k not in QUERIES:
            raise KeyError(f"oracle for unknown query {k}")
        ORACLES[k] = v.strip()
