"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where one exists, the SQL with equal results."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add
