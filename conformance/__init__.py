"""Registered queries with the SQL that must give the same rows.

A case is a function of (spark, directory) with an optional SQL text. The SQL is
written apart from the Spark plan and runs on the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate case {name}")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register
