"""Registry of named queries: name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None).

Oracle SQL runs in DuckDB over the same parquet tables (registered as views
named after the tables); it aliases, casts and rounds exactly as the Spark
side so results compare value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]  # SURVEY ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str = "", sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, tuple(ops.split()))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    import kiln.plans  # noqa: F401  (imports every plan module)
    return REGISTRY
