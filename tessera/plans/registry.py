"""Registry of named queries: name -> (spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # Importing the query modules fills REGISTRY.
    from tessera.plans import (q_allocation, q_evaluate, q_features, q_forecast, q_ml, q_profile,  # noqa: F401
                               q_io, q_search, q_streaming, q_timeseries)
    return REGISTRY
