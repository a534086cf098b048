"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where the semantics are SQL-expressible, an equivalent DuckDB oracle string."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}
DESCRIPTIONS: dict[str, str] = {}


def register(name: str, sql: str | None = None, ids: str = "") -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        DESCRIPTIONS[name] = ids or (fn.__doc__ or "").strip().splitlines()[0]
        return fn

    return deco
