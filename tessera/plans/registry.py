"""Query registry: key -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from tessera.sources.fixtures import with_views

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``.

    ``sql`` is DuckDB SQL over the base tables and the stand-in views
    (``ratings``, ``items``, ``txn`` ...), which are prefixed as CTEs.
    """
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_views(sql)
        return fn
    return deco
