"""All registered queries of the record-linkage engine and their SQL counterparts, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, market: bool = False) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the final SELECT of its SQL counterpart; with ``market`` that
    reads the records by larger countries."""

    def put(f: Query) -> Query:
        from .sql import statement

        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = statement(sql, market)
        return f

    return put


def _load() -> None:
    from . import directory, linkage, reports, retrieval, stages, widened  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
