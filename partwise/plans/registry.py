"""Registration of queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None) -> Callable:
    """Registers a query under its function's name."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add
