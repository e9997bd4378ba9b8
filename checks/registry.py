"""The register of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None) -> Callable[[Query], Query]:
    """Add a query under ``name``; ``sql`` is its DuckDB form."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add
