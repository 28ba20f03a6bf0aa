"""Named queries, each next to the SQL that says what it must return."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its check if it has one."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return run

    return register


def view(name: str, sql: str) -> None:
    """Define a step that the checks can select from."""
    VIEWS[name] = sql


def with_views(sql: str) -> str:
    """Put the steps that ``sql`` mentions, and those that they do, in a WITH list."""
    needed: set[str] = set()
    waiting = [sql]
    while waiting:
        text = waiting.pop()
        for name in VIEWS.keys() - needed:
            if re.search(rf"\b{name}\b", text):
                needed.add(name)
                waiting.append(VIEWS[name])
    if not needed:
        return sql
    steps = ",\n".join(f"{n} AS (\n{VIEWS[n].strip()}\n)" for n in VIEWS if n in needed)
    return f"WITH {steps}\n{sql.strip()}"
