"""Name, Spark callable and SQL of every registered query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.standins import with_ctes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, *ctes: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``ctes`` name the stand-ins its SQL builds on."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_ctes(*ctes, sql=sql) if ctes else sql
        return fn

    return add
