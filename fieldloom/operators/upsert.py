"""Repeatable upserts: new values win, missing ones keep what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .harmonize import merge_items

ITEM_KEY = ["category", "name", "source_standard"]
ITEM_COLUMNS = [
    "title", "description", "data_type", "byte_length", "decimal_scale", "is_required", "is_nullable", "default_value",
    "allowed_values", "format_mask", "source_url", "version",
]


def latest_values(rows: DataFrame, key: list[str], columns: list[str], seq: str) -> DataFrame:
    """Per key and column the newest value that is not NULL.

    Grouping treats NULL keys as equal, so a missing source does not multiply
    rows.  Both sides of an upsert go through one aggregation with map-side
    combination; no join and no dependence on the order of arrival.
    """
    return rows.groupBy(*key).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns])


def reduce_batch(norm: DataFrame, *batch: str) -> DataFrame:
    """One row per natural key, and per ``batch`` column, from normalized items."""
    return merge_items(norm, [*ITEM_KEY, *batch]).select(*ITEM_KEY, *ITEM_COLUMNS, *batch)


def upsert_items(base: DataFrame, delta: DataFrame) -> DataFrame:
    """``delta`` over ``base``; rows without a match on either side stay."""
    both = base.withColumn("__seq", F.lit(0)).unionByName(delta.withColumn("__seq", F.lit(1)))
    return latest_values(both, ITEM_KEY, ITEM_COLUMNS, "__seq")


def upsert_raw_items(norm: DataFrame, is_base, is_delta) -> DataFrame:
    """``upsert_items`` of the items of two conditions, reduced in one merge with the side as part of the key.

    An item may be on both sides.
    """
    sides = F.array_compact(F.array(F.when(is_base, 0), F.when(is_delta, 1)))
    both = reduce_batch(norm.withColumn("side", F.explode(sides)), "side")
    return latest_values(both, ITEM_KEY, ITEM_COLUMNS, "side")


def upsert_categories(base: DataFrame, delta: DataFrame) -> DataFrame:
    both = base.withColumn("__seq", F.lit(0)).unionByName(delta.withColumn("__seq", F.lit(1)))
    return latest_values(both, ["name"], ["description", "source"], "__seq")


def derive_categories(declared: DataFrame, items: DataFrame) -> DataFrame:
    """Declared categories in order, plus the ones only items mention."""
    known = latest_values(declared, ["name"], ["description", "source"], "seq")
    missing = items.select(F.col("category").alias("name")).distinct().join(known.select("name"), "name", "left_anti")
    nothing = F.lit(None).cast("string")
    return known.unionByName(missing.select("name", nothing.alias("description"), nothing.alias("source")))
