"""Registry of the queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return add


def load_all() -> None:
    from loanloom.plans import (  # noqa: F401
        feature_queries, profile_queries, ranking_queries, binning_queries, drift_queries, strategy_queries, time_queries,
        graph_queries, learning_queries, text_queries, io_queries, stream_queries, neighbour_queries,
    )
