"""Queries over the driver's tables, one for each operator, with the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the SQL for the same rows."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _QUERIES["min_segments"](spark, sf_dir)


from eventweave.plans import dataset_queries, function_queries, order_queries, timeline_queries  # noqa: E402, F401  each registers its queries
