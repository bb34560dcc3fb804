"""Named queries and their DuckDB statements.

Each query is a function ``(spark, sf_dir) -> DataFrame``; the statement
next to it computes the same rows over the raw tables in DuckDB. Queries
whose result depends on a trained model or a random draw register no
statement (the driver then checks row counts only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that its ``@register`` calls run."""
    from edgefilter.plans import (  # noqa: F401
        q_bloom,
        q_knn,
        q_ml,
        q_model,
        q_profile,
        q_sources,
        q_stream,
    )


def queries() -> dict[str, Query]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
