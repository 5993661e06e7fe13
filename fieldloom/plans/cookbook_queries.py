"""The cookbook: everyday questions asked of the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import entity_of, field_of
from ..functions.values import is_json_array, is_json_object
from ..operators import reports as R
from .catalog import catalog, categories

CATEGORY, ENTITY, KEYWORD, SOURCE, ITEM = "MACHINERY", "invoice", "gtin", "EUROPE", "invoice.cust_key1"
TOP = 20


def items_with_category(spark, root):
    """Items under the id of their category."""
    ids = categories(spark, root).select("category_id", F.col("name").alias("category"))
    return catalog(spark, root).select("category", "name", "source_standard").join(ids, "category")


def category_counts(spark, root):
    return R.category_counts(catalog(spark, root), categories(spark, root)).orderBy(F.desc("items"), "category")


def headline_totals(spark, root):
    items = catalog(spark, root).agg(F.count("*")).scalar()
    cats = categories(spark, root).agg(F.count("*")).scalar()
    return spark.range(1).select(items.alias("data_items"), cats.alias("categories"))


def items_in_category(spark, root):
    wanted = categories(spark, root).filter(F.col("name") == CATEGORY).select("name").scalar()
    return (catalog(spark, root).filter(F.col("category") == wanted)
            .select("name", "title", "data_type", "is_required").orderBy("name"))


def entity_fields(spark, root):
    return (catalog(spark, root).filter(F.startswith("name", F.lit(ENTITY + ".")))
            .select("category", "name", "data_type", "byte_length", "description").orderBy("name", "category"))


def keyword(spark, root):
    hit = F.lit(False)
    for c in ("name", "title", "description"):
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(KEYWORD)), F.lit(False))
    return catalog(spark, root).filter(hit).select("category", "name", "title", "source_standard")


def entity_field_counts(spark, root):
    return (catalog(spark, root).filter(F.contains("name", F.lit("."))).groupBy(entity_of(F.col("name")).alias("entity"))
            .agg(F.count("*").alias("fields")).orderBy(F.desc("fields"), "entity").limit(TOP))


def type_distribution(spark, root):
    return catalog(spark, root).groupBy("data_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "data_type")


def required_only(spark, root):
    return (catalog(spark, root).filter("is_required").select("category", "name", "data_type", "byte_length")
            .orderBy("name", "category"))


def longest_strings(spark, root):
    return (catalog(spark, root).filter((F.col("data_type") == "VARCHAR") & F.col("byte_length").isNotNull())
            .select("category", "name", "byte_length").orderBy(F.desc("byte_length"), "name", "category").limit(TOP))


def has_enum(spark, root):
    return (catalog(spark, root).filter(F.col("allowed_values").isNotNull())
            .select("category", "name", "allowed_values").orderBy("name", "category"))


def divergent_enum(spark, root):
    return (catalog(spark, root).filter(is_json_object(F.col("allowed_values")))
            .select("category", "name", "source_standard", "allowed_values"))


def enum_expand(spark, root):
    flat = F.when(is_json_array(F.col("allowed_values")), F.from_json("allowed_values", "array<string>"))
    return catalog(spark, root).select("category", "name", F.explode(flat).alias("allowed_value"))


def enum_expand_by_source(spark, root):
    per_source = F.when(is_json_object(F.col("allowed_values")), F.from_json("allowed_values", "map<string,array<string>>"))
    return (catalog(spark, root).select("category", "name", F.explode(per_source).alias("source", "vs"))
            .select("category", "name", "source", F.explode("vs").alias("allowed_value")))


def items_per_source(spark, root):
    return (R.explode_sources(catalog(spark, root)).groupBy("source").agg(F.count("*").alias("items"))
            .orderBy(F.desc("items"), "source"))


def one_source(spark, root):
    return (catalog(spark, root).filter(F.contains("source_standard", F.lit(SOURCE)))
            .select("category", "name", "data_type").orderBy("name", "category"))


def trace_item(spark, root):
    return (catalog(spark, root).filter(F.col("name") == ITEM)
            .select("category", "name", "source_standard", "source_url", "version"))


def _several(items):
    return items.filter(F.contains("source_standard", F.lit(";")))


def corroborated(spark, root):
    n = F.size(F.split("source_standard", ";"))
    return (_several(catalog(spark, root)).select("category", "name", "source_standard", n.alias("n_sources"))
            .orderBy(F.desc("n_sources"), "name", "category"))


def corroborated_by_category(spark, root):
    return (_several(catalog(spark, root)).groupBy("category").agg(F.count("*").alias("corroborated"))
            .orderBy(F.desc("corroborated"), "category"))


def format_masks(spark, root):
    return (catalog(spark, root).filter(F.col("format_mask").isNotNull())
            .select("category", "name", "data_type", "format_mask").orderBy("name", "category"))


def source_catalog(spark, root):
    return (catalog(spark, root).filter(F.contains("source_standard", F.lit(SOURCE)))
            .select("category", "name", "title", "format_mask", "byte_length").orderBy("name", "category"))


def missing_description(spark, root):
    blank = F.coalesce(F.col("description"), F.lit("")) == ""
    return catalog(spark, root).agg(F.count_if(blank).alias("missing_description"))


def category_coverage(spark, root):
    described = F.coalesce(F.col("description"), F.lit("")) != ""
    return catalog(spark, root).groupBy("category").agg(
        F.count("*").alias("items"), F.count_if(described).alias("with_desc"),
        F.count_if(F.col("allowed_values").isNotNull()).alias("with_enum"),
        F.count_if("is_required").alias("required")).orderBy(F.desc("items"), "category")


def shared_fields(spark, root):
    """Field names that occur under several (joined) source lists, most frequent first."""
    return (catalog(spark, root).groupBy("category", field_of(F.col("name")).alias("field"))
            .agg(F.count_distinct("source_standard").alias("sources"), F.count("*").alias("occurrences"))
            .filter("occurrences > 1 AND sources > 1").orderBy(F.desc("occurrences"), "category", "field").limit(TOP))


QUERIES = {
    "items_with_category": items_with_category,
    "category_left_counts": lambda s, r: R.category_counts(catalog(s, r), categories(s, r)),
    "q_category_counts": category_counts,
    "q_headline_totals": headline_totals,
    "q_category_lookup": lambda s, r: categories(s, r).filter(F.col("name") == CATEGORY).select("category_id", "name"),
    "q_items_in_category": items_in_category,
    "q_entity_fields": entity_fields,
    "q_keyword": keyword,
    "q_entity_field_counts": entity_field_counts,
    "q_type_distribution": type_distribution,
    "q_required_only": required_only,
    "q_longest_strings": longest_strings,
    "q_has_enum": has_enum,
    "q_divergent_enum": divergent_enum,
    "q_enum_expand": enum_expand,
    "q_enum_expand_by_source": enum_expand_by_source,
    "q_items_per_source": items_per_source,
    "q_one_source": one_source,
    "q_trace_item": trace_item,
    "q_corroborated": corroborated,
    "q_corroborated_by_category": corroborated_by_category,
    "q_format_masks": format_masks,
    "q_source_catalog": source_catalog,
    "q_missing_description": missing_description,
    "q_category_coverage": category_coverage,
    "q_shared_fields": shared_fields,
}
