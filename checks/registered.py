"""Collects registered queries with the SQL that checks each."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.sql import query

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``key``; ``sql`` may name any entity defined in ``checks.sql``."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = query(sql)
        return fn

    return register
