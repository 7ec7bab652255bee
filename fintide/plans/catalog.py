"""Query catalogue: name → (Spark job over the test tables, DuckDB oracle SQL).

Each query callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the whole tables.  Oracle SQL runs in DuckDB over the same parquet
tables (registered under their table names) and must produce the same rows
with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
            # A new Dataset each call: a caller that keeps one must not hand back a finished
            # execution (and its shuffle files) when it runs the query again.
            return fn(spark, sf_dir).select("*")

        fresh.__name__ = fn.__name__
        fresh.__doc__ = fn.__doc__
        QUERIES[name] = fresh
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from fintide.plans import (  # noqa: F401
        q_clients,
        q_portfolio,
        q_ml,
        q_scoring,
        q_transactions,
        q_nav,
        q_sampling,
        q_io,
        q_streaming,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
