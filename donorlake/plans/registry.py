"""Registry of checkable queries: name → (Spark builder, oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables. The SQL (DuckDB dialect, driver tables as views) is
the independent oracle; ``None`` marks a job that SQL cannot express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module (each registers on import)."""
    from donorlake.plans import (  # noqa: F401
        q_functions,
        q_landing,
        q_masters,
        q_normalize,
        q_quality,
        q_specs,
        q_tables,
    )
