"""Registry of runnable queries, each next to the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL where there is one."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def load_all() -> None:
    from rowmill.plans import (  # noqa: F401
        queries_files,
        queries_functions,
        queries_mapping,
        queries_matching,
        queries_report,
        queries_state,
        queries_validation,
    )
