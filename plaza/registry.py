"""Where queries are registered by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import CTES, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    def add(f: Callable[[Views], DataFrame]) -> Callable:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            SQL[key] = CTES + sql
        return f

    return add
