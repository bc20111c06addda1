"""Named queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with SQL of the same result where SQL can say it."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECK_SQL[fn.__name__] = sql
        return fn
    return add
