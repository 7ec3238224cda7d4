"""Named queries: the Spark form and, where SQL can say it, the check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add
