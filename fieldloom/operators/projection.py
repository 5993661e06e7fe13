"""Projection of the catalog for user interfaces: groups and their fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import entity_of
from ..functions.rules import (CATALOG_ENTITY, WIZARD_GROUP, char_length, ui_field_name, ui_group, validation_spec)
from ..functions.values import join_non_empty
from .ranking import with_global_rank
from .reports import atomic_sources

# Texts of the two special groups, and bytes reserved per character.
WIZARD_TEXT = ("Transient wizard and junction (relation) models, grouped together; "
               "Name keeps the full source path.")
CATALOG_TEXT = "GS1 Application Identifier catalog."
BYTES_PER_CHAR = 4


def longest_prefix_parent(entities: DataFrame) -> DataFrame:
    """Nearest existing ancestor of each dotted entity.

    Every entity lists its own proper prefixes, which are then looked up by an
    equi-join: work grows with the number of segments, not with pairs of entities.
    """
    entities = entities.select("entity").distinct()
    segments = F.split("entity", r"\.")
    depths = F.when(F.size(segments) > 1, F.sequence(F.lit(1), F.size(segments) - 1))
    prefixes = entities.select("entity", F.explode(F.transform(
        depths, lambda d: F.array_join(F.slice(segments, F.lit(1), d), "."))).alias("prefix"))
    known = entities.select(F.col("entity").alias("prefix"))
    found = prefixes.join(known, "prefix").groupBy("entity").agg(F.max_by("prefix", F.length("prefix")).alias("parent"))
    return entities.join(found, "entity", "left")


def ui_groups(items: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per group: id by name, most frequent category, sources, text."""
    rows = items.select("name", "category", "first_ord", "source_standard", ui_group(F.col("name")).alias("group_name"),
                        entity_of(F.col("name")).alias("entity"))
    modal = (rows.groupBy("group_name", "category").agg(F.count("*").alias("n"))
             .groupBy("group_name").agg(F.min_by("category", F.struct(-F.col("n"), "category")).alias("category")))
    # First item that brings a source, and the position of the source in that item.
    sources = (rows.select("group_name", "first_ord", "name",
                           F.posexplode(atomic_sources(F.col("source_standard"))).alias("pos", "source"))
               .groupBy("group_name", "source").agg(F.min(F.struct("first_ord", "name", "pos")).alias("at"))
               .groupBy("group_name").agg(F.array_sort(F.collect_list(F.struct("at", "source"))).alias("ss"))
               .select("group_name", join_non_empty(F.transform("ss", lambda s: s["source"]), "; ").alias("source")))
    parents = longest_prefix_parent(rows.select("entity")).withColumnRenamed("entity", "group_name")
    text = (F.when(F.col("group_name") == WIZARD_GROUP, WIZARD_TEXT).when(F.col("group_name") == CATALOG_ENTITY, CATALOG_TEXT)
            .when(F.col("parent").isNotNull(), F.concat(F.lit("Component (sub-entity) of "), F.col("parent"), F.lit("."))))
    ids = categories.select("category_id", F.col("name").alias("category"))
    groups = (modal.join(sources, "group_name", "left").join(parents, "group_name", "left").join(ids, "category", "left")
              .select("group_name", "category_id", text.alias("description"), "source"))
    return with_global_rank(groups, ["group_name"], "group_id")


def ui_items(items: DataFrame, groups: DataFrame) -> DataFrame:
    """Every item under its group, with lengths and a validation rule."""
    length = char_length(F.col("data_type"), F.col("byte_length"), F.col("decimal_scale"))
    rows = (items.withColumn("group_name", ui_group(F.col("name"))).withColumn("char_length", length)
            .join(groups.select("group_id", "group_name"), "group_name"))
    spec = validation_spec(F.col("data_type"), F.col("format_mask"), F.col("allowed_values"), F.col("decimal_scale"),
                           F.col("char_length"))
    return rows.select(
        "group_id", ui_field_name(F.col("name"), F.col("group_name")).alias("name"), "title", "description", "data_type",
        "char_length", (F.col("char_length") * BYTES_PER_CHAR).alias("byte_length"), "decimal_scale", "is_required",
        "is_nullable", "default_value", "allowed_values", spec.alias("validation_specs"), "version")
