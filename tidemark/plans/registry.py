"""All queries of the engine's own operators, with the SQL that gives the same rows."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function under ``name``, with its SQL."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return add
