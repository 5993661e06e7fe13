"""Row-level functions applied to every item."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import rules as U
from ..functions.rows import explode_list
from ..functions.values import parse_allowed_values
from ..operators import checks as C
from ..operators import enrich as E
from ..operators import projection as P
from ..operators import reports as R
from ..sources.tables import SOURCES, view
from .catalog import catalog, categories
from .projection_queries import groups, written_ui

# Display names of the test catalog.
DISPLAY_NAMES = {"invoice": "Invoice", "1_urgent": "Urgent order", "order": "Sales order"}


def _items(spark, root, *columns):
    return catalog(spark, root).select("category", "name", *columns)


def _entities(spark, root):
    return catalog(spark, root).select(N.entity_of(F.col("name")).alias("entity")).distinct()


def split_entity_field(spark, root):
    n = F.col("name")
    return _items(spark, root, N.entity_of(n).alias("entity"), N.entity_or_blank(n).alias("namespace"),
                  N.field_of(n).alias("field"), N.after_first_dot(n).alias("column_path"))


def synthesize(spark, root):
    text = U.synthesize_description(F.col("name"), F.col("title"), F.col("allowed_values"), DISPLAY_NAMES)
    return catalog(spark, root).filter(U.is_blank(F.col("description"))).select("category", "name", text.alias("description"))


def allowed_values(spark, root):
    raw = view(spark, root, "raw_items")
    return explode_list(raw, ["ord"], parse_allowed_values(F.col("allowed_values")), "pos", "value", position=True)


def validation(spark, root):
    length = U.char_length(F.col("data_type"), F.col("byte_length"), F.col("decimal_scale"))
    spec = U.validation_spec(F.col("data_type"), F.col("format_mask"), F.col("allowed_values"), F.col("decimal_scale"), length)
    return _items(spark, root, spec.alias("validation_spec"))


def ui_field_name(spark, root):
    group = U.ui_group(F.col("name"))
    return _items(spark, root, group.alias("group_name"), U.ui_field_name(F.col("name"), group).alias("field_name"))


def dialect_types(spark, root):
    is_fk = U.relation_target(F.col("description")).isNotNull()
    types = [F.struct(F.lit(d).alias("dialect"), U.dialect_type(
        d, F.col("data_type"), F.col("byte_length"), F.col("decimal_scale"), is_fk).alias("column_type")) for d in U.DIALECTS]
    return _items(spark, root, F.inline(F.array(*types)))


def enum_checks(spark, root):
    column = N.identifier(N.after_first_dot(F.col("name")))
    check = U.enum_check(column, F.col("allowed_values"))
    return catalog(spark, root).select("category", "name", check.alias("check_text")).filter(F.col("check_text").isNotNull())


def overridden(spark, root):
    """The catalog after the curated texts were applied."""
    return E.override_descriptions(catalog(spark, root), view(spark, root, "curated"))


def finished(spark, root):
    """The catalog as it is delivered: curated texts first, then texts for what is still blank."""
    return E.backfill_descriptions(overridden(spark, root).drop("changed"), DISPLAY_NAMES)


def raw_entities(spark, root):
    """Entities before aliasing, where the dotted hierarchy is still complete."""
    dotted = N.snake_dotted(F.col("name"))
    return view(spark, root, "raw_items").select(N.entity_of(dotted).alias("entity")).distinct()


QUERIES = {
    "split_entity_field": split_entity_field,
    "identifier_norm": lambda s, r: _entities(s, r).select("entity", N.identifier(F.col("entity")).alias("identifier")),
    "humanize_entity": lambda s, r: _entities(s, r).select("entity", N.humanize(F.col("entity"), DISPLAY_NAMES).alias("display_name")),
    "synthesize_description": synthesize,
    "allowed_values_parse": allowed_values,
    "relation_target": lambda s, r: _items(s, r, U.relation_target(F.col("description")).alias("target")),
    "is_collection": lambda s, r: _items(s, r, U.is_collection(F.col("description")).alias("is_collection")),
    "char_length_policy": lambda s, r: _items(s, r, U.char_length(
        F.col("data_type"), F.col("byte_length"), F.col("decimal_scale")).alias("char_length")),
    "validation_spec": validation,
    "entity_bucket": lambda s, r: _entities(s, r).select("entity", U.entity_bucket(F.col("entity")).alias("bucket")),
    "ui_field_name": ui_field_name,
    "dialect_type": dialect_types,
    "enum_check": enum_checks,
    "coverage_grade": lambda s, r: R.graded_coverage(overridden(s, r), view(s, r, "curated")),
    "curated_override": lambda s, r: overridden(s, r).select("category", "name", "description", "changed"),
    "finished_catalog": lambda s, r: finished(s, r).select("category", "name", "description"),
    "check_report_finished": lambda s, r: C.report(finished(s, r), categories(s, r), view(s, r, "curated"), written_ui(s, r), groups(s, r)),
    "check_finished": lambda s, r: C.description(finished(s, r)),
    "backfill_descriptions": lambda s, r: E.backfill_descriptions(catalog(s, r), DISPLAY_NAMES).select(
        "category", "name", "description"),
    "longest_prefix_parent": lambda s, r: P.longest_prefix_parent(raw_entities(s, r)),
    "source_category_matrix": lambda s, r: R.source_category_matrix(catalog(s, r), SOURCES),
    "source_category_edges": lambda s, r: R.source_category_edges(catalog(s, r)),
    "coverage_by_category": lambda s, r: R.coverage(overridden(s, r), view(s, r, "curated")),
    "dictionary_stats": lambda s, r: R.dictionary_stats(catalog(s, r), categories(s, r)),
}
