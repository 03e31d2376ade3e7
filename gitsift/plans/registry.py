"""Named queries over the driver's tables, each with its check SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = function
        if sql is not None:
            CHECK_SQL[name] = sql
        return function

    return register


def with_tables(tables: str, select: str = "") -> str:
    return f"WITH RECURSIVE {tables} {select}"
