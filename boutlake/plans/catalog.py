"""All queries of the library by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boutlake.plans import bout_queries, list_queries, store_queries, table_queries

ALL = bout_queries.QUERIES | table_queries.QUERIES | list_queries.QUERIES | store_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
