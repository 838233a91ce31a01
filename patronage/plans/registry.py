"""Registry of named queries and their independent SQL oracles.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Its oracle is an ANSI SQL
text over the raw driver tables (DuckDB dialect), written independently of
the Spark code so that the two only agree when the semantics do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ctes(body: str, **parts: str) -> str:
    """``WITH a AS (...), b AS (...) body`` in the given order."""
    if not parts:
        return body
    inner = ",\n".join(f"{k} AS ({v.strip()})" for k, v in parts.items())
    return f"WITH {inner}\n{body}"
