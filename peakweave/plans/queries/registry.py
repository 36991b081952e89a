"""Named queries and the SQL they are compared with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("sequences", "cells", "metrics", "text", "streams")


def query(sql: str | None = None, views: tuple[str, ...] = (), name: str | None = None):
    """Register a query under its function name; `views` are put in front of the SQL as CTEs."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in _QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = with_views(sql, views)
        return fn

    return add


def with_views(sql: str, views: tuple[str, ...]) -> str:
    from peakweave.plans.queries.views import VIEW_SQL

    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in views)
    body = sql.strip()
    if not ctes:
        return body
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(opening):
            return f"{opening}{ctes},\n{body[len(opening):]}"
    return f"WITH {ctes}\n{body}"


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"peakweave.plans.queries.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def r(c: str | Column, digits: int = 6) -> Column:
    """A double rounded for comparison, without negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def joined(c: str | Column) -> Column:
    """An array as text."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, ",")
