"""Normalization, alias and merge queries over the raw items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import snake_case
from ..functions.rules import completeness_score
from ..functions.values import truthy
from ..operators import harmonize as H
from ..sources.tables import ENTITY_ALIASES, FIELD_ALIASES, view
from .catalog import catalog, merged, normalized

KEY = H.KEY


def _members(spark, root, *columns) -> DataFrame:
    """Merged keys only: a lone item is not touched by any rule."""
    return normalized(spark, root).groupBy(*KEY).agg(F.count("*").alias("n_members"), *columns).filter("n_members > 1")


def merge_primary(spark, root):
    cols = ["data_type", "decimal_scale", "default_value", "format_mask"]
    return _members(spark, root, H.primary_row(cols).alias("p")).select(*KEY, "n_members", "p.*")


def merge_description(spark, root):
    return _members(spark, root, H.longest_description().alias("description"))


def merge_title(spark, root):
    df = _members(spark, root, H.primary_row(["title"]).alias("p"), H.first_title().alias("f"))
    own = F.when(truthy(F.col("p.title")), F.col("p.title"))
    return df.select(*KEY, "n_members", F.coalesce(own, "f").alias("title"))


def merge_byte_length(spark, root):
    return _members(spark, root, F.max("byte_length").alias("byte_length"))


def merge_required(spark, root):
    return _members(spark, root, H.any_required().alias("is_required")).withColumn("is_nullable", ~F.col("is_required"))


def _with_facts(spark, root, kinds) -> DataFrame:
    norm = H.only_merging(normalized(spark, root), KEY)
    counts = norm.groupBy(*KEY).agg(F.count("*").alias("n_members"))
    return H.join_by_key(counts, H.collect_facts(norm, KEY, kinds), KEY, "left")


def merge_provenance(spark, root):
    df = _with_facts(spark, root, (H.SOURCE, H.URL, H.VERSION))
    return df.select(*KEY, "n_members", H.joined_sources().alias("source_standard"), H.joined_urls().alias("source_url"),
                     H.joined_versions().alias("version"))


def merge_allowed_values(spark, root):
    df = H.add_merged_values(_with_facts(spark, root, (H.VALUE,)), "allowed_values")
    return df.select(*KEY, "n_members", "allowed_values")


def _resolved(spark, root):
    return H.resolve_names(view(spark, root, "raw_items").select("ord", "name"), ENTITY_ALIASES, FIELD_ALIASES)


QUERIES = {
    "snake_case": lambda s, r: view(s, r, "raw_items").select("ord", "name", snake_case(F.col("name")).alias("snake_name")),
    "normalize_name": lambda s, r: _resolved(s, r).select("ord", F.col("name").alias("raw_name"), F.col("clean_name").alias("name")),
    "completeness_score": lambda s, r: view(s, r, "raw_items").select("ord", completeness_score().alias("score")),
    "entity_alias_join": lambda s, r: _resolved(s, r).select(
        "ord", "name", "source_entity", F.coalesce("canonical_entity", "source_entity").alias("entity")),
    "field_alias_join": lambda s, r: _resolved(s, r).select("ord", "base_name", F.col("clean_name").alias("name")),
    "group_concepts": lambda s, r: H.group_concepts(normalized(s, r)),
    "merge_primary": merge_primary,
    "merge_description": merge_description,
    "merge_title": merge_title,
    "merge_byte_length": merge_byte_length,
    "merge_required": merge_required,
    "merge_provenance": merge_provenance,
    "merge_allowed_values": merge_allowed_values,
    "merged_catalog": merged,
    "merge_report": lambda s, r: H.merge_report(normalized(s, r)),
    "merge_summary": lambda s, r: H.merge_summary(catalog(s, r)),
    "related_concepts": lambda s, r: H.related_concepts(catalog(s, r)),
    "entity_alias_report": lambda s, r: H.alias_usage(view(s, r, "raw_items"), ENTITY_ALIASES),
    "field_alias_report": lambda s, r: H.field_alias_usage(view(s, r, "raw_items"), ENTITY_ALIASES, FIELD_ALIASES),
}
