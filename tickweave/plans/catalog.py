"""Registry of named queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn

    return register


def load_all() -> None:
    from . import ingest_queries, quality_queries, stat_queries  # noqa: F401
    from . import health_queries, micro_queries, scalar_queries, stream_queries  # noqa: F401
    from . import command_queries  # noqa: F401  its checks build on those of the others
