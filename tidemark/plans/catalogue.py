"""Registry of the runnable queries and their DuckDB SQL twins.

Each query takes ``(spark, sf_dir)``, reads the scale-factor tables, maps them
to the job's input shape (``tidemark.plans.inputs``) and runs the job.  The SQL
twin is written independently, in the reference's own window-function style,
so that the scalable Spark forms are checked against the literal semantics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tidemark.plans import queries, round_trips  # noqa: F401
