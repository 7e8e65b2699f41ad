"""Where the catalogue modules register their queries and check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return keep
