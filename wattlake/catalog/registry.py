"""Names of queries, their functions and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wattlake.catalog.steady import SUMS, steady_rows, steady_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``f(spark, sf_dir)``; ``sql`` is left out where no SQL states the result."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = wraps(f)(lambda spark, sf_dir: steady_rows(f(spark, sf_dir), name)) if name in SUMS else f
        if sql is not None:
            ORACLES[name] = steady_sql(sql, name)
        return f

    return register
