"""Runnable queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    from codeloom.registry import catalog_queries, classification_queries, evaluation_queries, file_queries, stream_queries

    merged = {}
    for module in (catalog_queries, evaluation_queries, classification_queries, file_queries, stream_queries):
        merged.update(module.QUERIES)
    return merged
