"""Registry of named queries: ``(spark, root) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cookbook_queries, extract_queries, merge_queries, projection_queries, rule_queries, search_queries

Query = Callable[[SparkSession, str], DataFrame]
MODULES = [merge_queries, cookbook_queries, rule_queries, projection_queries, extract_queries, search_queries]


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for module in MODULES:
        for key, query in module.QUERIES.items():
            if key in out:
                raise ValueError(f"query {key} registered twice")
            out[key] = query
    return out
