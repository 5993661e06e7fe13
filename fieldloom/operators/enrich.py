"""Descriptions from outside: curated overrides and synthesized texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import is_blank, synthesize_description


def one_text_per_name(curated: DataFrame) -> DataFrame:
    """``(name, description)``: of several texts for a name the smallest holds; a missing text only if there is no other."""
    return curated.groupBy("name").agg(F.min("description").alias("description"))


def override_descriptions(items: DataFrame, curated: DataFrame) -> DataFrame:
    """Curated texts replace whatever is there, by exact name.

    ``changed`` marks the rows that differ from before, so a second run changes
    nothing.  This is a stage of its own after the merge: the text of a source
    does not survive it.
    """
    texts = one_text_per_name(curated).withColumnRenamed("description", "__text")
    text = F.coalesce(F.col("__text"), F.col("description"))
    return (items.join(texts, "name", "left")
            .withColumn("changed", ~text.eqNullSafe(F.col("description")))
            .withColumn("description", text).drop("__text"))


def unmatched_overrides(items: DataFrame, curated: DataFrame) -> DataFrame:
    """Curated names that no item carries."""
    return curated.join(items.select("name"), "name", "left_anti")


def backfill_descriptions(items: DataFrame, display: Mapping[str, str], category: str | None = None) -> DataFrame:
    """Fill blank descriptions from the item's own metadata; touch nothing else."""
    needed = is_blank(F.col("description"))
    if category is not None:
        needed = needed & (F.col("category") == category)
    text = synthesize_description(F.col("name"), F.col("title"), F.col("allowed_values"), display)
    return items.withColumn("description", F.when(needed, text).otherwise(F.col("description")))
