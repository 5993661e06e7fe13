"""The catalog of one table set: built once per session, then read many times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.harmonize import merge_items, normalize_items
from ..operators.ranking import with_global_rank
from ..sources.tables import ENTITY_ALIASES, FIELD_ALIASES, view
from ..storage import materialize

_SNAPSHOTS: dict[tuple[str, str, str], DataFrame] = {}


def normalized(spark: SparkSession, root: str) -> DataFrame:
    return normalize_items(view(spark, root, "raw_items"), ENTITY_ALIASES, FIELD_ALIASES)


def merged(spark: SparkSession, root: str) -> DataFrame:
    """The catalog as a lazy plan over the tables."""
    return merge_items(normalized(spark, root))


def _snapshot(spark: SparkSession, root: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, root, name)
    if key not in _SNAPSHOTS:
        _SNAPSHOTS[key] = build()
    return _SNAPSHOTS[key]


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """The written catalog, partitioned by category.

    Everything that asks questions of the catalog reads this table, so a filter
    on category prunes folders and a filter on name reaches the Parquet scan.
    It shows the tables as of the first use in the session; ``forget`` starts over.
    """
    return _snapshot(spark, root, "catalog", lambda: materialize(merged(spark, root), "catalog", "category"))


def categories(spark: SparkSession, root: str) -> DataFrame:
    """Category dimension: declared names plus one without items."""
    def build() -> DataFrame:
        ranked = with_global_rank(view(spark, root, "category_names"), ["name"], "category_id")
        return materialize(ranked.select(F.col("category_id").cast("int").alias("category_id"), "name"), "categories")

    return _snapshot(spark, root, "categories", build)


def forget(spark: SparkSession, root: str) -> None:
    """Drop the session's reference to the written tables of ``root``."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _SNAPSHOTS if k[:2] == (app, root)]:
        del _SNAPSHOTS[key]
