"""Registry of named queries and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's test
tables; its oracle is an ANSI SQL string over the same tables (DuckDB views
named like the tables). Column names are the same on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its oracle (omit only for
    operators with no SQL twin)."""
    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def load_all() -> None:
    # importing the modules registers their queries
    from lakeshelf.plans import (  # noqa: F401
        q_changes, q_clean, q_dims, q_impute, q_io, q_layout, q_profile, q_search, q_stream, q_fact,
    )
FLAGSHIP = "fact_city_month"
