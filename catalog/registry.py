"""Registration of queries and composition of their reference SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.views import VIEWS

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; without SQL it is checked by the tests only."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return register


def with_views(sql: str) -> str:
    """Put the definitions of the views a statement uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    heads = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(values: list, index: str) -> str:
    """SQL for the value at a 1-based index of a fixed list."""
    parts = []
    for v in values:
        if v is None:
            parts.append("NULL")
        elif isinstance(v, bool):
            parts.append(str(v).upper())
        elif isinstance(v, (int, float)):
            parts.append(str(v))
        else:
            parts.append(sql_text(v))
    return f"list_extract([{', '.join(parts)}], {index})"
