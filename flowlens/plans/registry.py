"""Query registry: key -> Spark builder and key -> DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco
