"""Checked queries: a DataFrame over the given tables with SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, under its function's name or another one, together with its SQL."""

    def register(query: Query) -> Query:
        key = name or query.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = query
        ORACLES[key] = sql
        return query

    return register
