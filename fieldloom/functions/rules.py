"""Derivation rules over item columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import entity_of, field_of, humanize, identifier
from .values import display_values, string_members, truthy

# Words that mark a transient dialog model, and the group they form.
WIZARD_WORDS = ["ask", "start", "result", "preview", "context", "default", "show"]
WIZARD_GROUP = "Wizard"
CATALOG_ENTITY = "gs1"

# Characters shown per logical type.
CHAR_LENGTHS = {
    "TEXT": 4000, "OBJECT": 4000, "INTEGER": 11, "BIGINT": 20, "BOOLEAN": 5, "DATE": 10,
    "DATETIME": 25, "TIME": 8, "RELATION": 64, "BLOB": 8000,
}
DEFAULT_CHAR_LENGTH = 255

# Validation pattern per logical type.
PATTERNS = {
    "DATE": r"^\d{4}-\d{2}-\d{2}$",
    "DATETIME": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2})?",
    "TIME": r"^\d{2}:\d{2}(:\d{2})?$",
    "BOOLEAN": r"^(true|false|0|1)$",
    "INTEGER": r"^-?\d+$",
    "BIGINT": r"^-?\d+$",
    "RELATION": "key reference",
}

# Column types by dialect (sqlite, postgres, mysql).
DIALECTS = ("sqlite", "postgres", "mysql")
COLUMN_TYPES = {
    "VARCHAR": ("VARCHAR(%n)", "VARCHAR(%n)", "VARCHAR(%n)"),
    "TEXT": ("TEXT", "TEXT", "TEXT"),
    "INTEGER": ("INTEGER", "INTEGER", "INT"),
    "DECIMAL": ("DECIMAL(18,%s)", "DECIMAL(18,%s)", "DECIMAL(18,%s)"),
    "BOOLEAN": ("BOOLEAN", "BOOLEAN", "TINYINT(1)"),
    "DATE": ("DATE", "DATE", "DATE"),
    "DATETIME": ("DATETIME", "TIMESTAMP", "DATETIME"),
    "TIME": ("TIME", "TIME", "TIME"),
    "RELATION": ("INTEGER", "INTEGER", "INT"),
    "OBJECT": ("TEXT", "JSONB", "JSON"),
    "BLOB": ("BLOB", "BYTEA", "BLOB"),
}
KEY_TYPES = ("INTEGER", "INTEGER", "INT")
# Types of the plain single-dialect table text.
PLAIN_TYPES = {
    "VARCHAR": "VARCHAR(%n)", "TEXT": "TEXT", "INTEGER": "INTEGER", "DECIMAL": "DECIMAL(18,%s)", "BOOLEAN": "BOOLEAN",
    "DATE": "DATE", "DATETIME": "DATETIME", "TIME": "TIME", "RELATION": "INTEGER",
}

# Coverage percentages and their colours, best first.
COVERAGE_COLOURS = [(100, "brightgreen"), (90, "green"), (75, "yellowgreen"), (50, "yellow")]
LOWEST_COLOUR = "orange"


def completeness_score() -> Column:
    """How much a row says about its field; decides the primary of a merge."""
    def points(n: int, cond: Column) -> Column:
        return F.when(cond, F.lit(n)).otherwise(F.lit(0))

    return (points(3, truthy(F.col("description"))) + points(1, truthy(F.col("title")))
            + points(1, truthy(F.col("data_type")) & (F.col("data_type") != "RELATION"))
            + points(1, F.col("byte_length").isNotNull()) + points(2, truthy(F.col("allowed_values"))))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def synthesize_description(name: Column, title: Column, allowed: Column, display: Mapping[str, str] | None = None) -> Column:
    """A factual sentence from the entity, the label and the allowed values."""
    label = F.trim(F.when(truthy(title), title).otherwise(field_of(name)))
    shown = F.array_distinct(F.filter(display_values(allowed), truthy))
    more = F.when(F.size(shown) > 12, F.concat(F.lit(", ... (+"), (F.size(shown) - 12).cast("string"), F.lit(" more)"))) \
        .otherwise("")
    values = F.when(
        F.size(display_values(allowed)) > 0,
        F.concat(F.lit(" Allowed values: "), F.array_join(F.slice(shown, 1, 12), ", "), more, F.lit(".")),
    ).otherwise("")
    return F.concat(humanize(entity_of(name), display), F.lit(": "), label, F.lit("."), values)


def relation_hint(description: Column) -> Column:
    return F.regexp_extract(description, r"(?i)\((?:links to|references)\s+([^)]*)\)", 1)


def relation_target(description: Column) -> Column:
    """Table a description links to; NULL for none and for several."""
    targets = F.filter(F.transform(F.split(relation_hint(description), ","), lambda t: F.trim(t)), lambda t: t != "")
    return F.nullif(F.when(F.size(targets) == 1, identifier(F.element_at(targets, 1))), F.lit(""))


def is_collection(description: Column) -> Column:
    return F.coalesce(F.contains(F.lower(description), F.lit("collection of")), F.lit(False))


def _positive(c: Column) -> Column:
    return F.coalesce(c > 0, F.lit(False))


def char_length(data_type: Column, byte_length: Column, scale: Column) -> Column:
    kind = F.upper(data_type)
    out = F.when(kind == "VARCHAR", F.when(_positive(byte_length), byte_length).otherwise(DEFAULT_CHAR_LENGTH))
    for name, length in CHAR_LENGTHS.items():
        out = out.when(kind == name, F.lit(length))
    out = out.when(kind.isin("DECIMAL", "DOUBLE"), F.when(_positive(scale), F.lit(20)).otherwise(19))
    return out.otherwise(DEFAULT_CHAR_LENGTH).cast("int")


def validation_spec(data_type: Column, mask: Column, allowed: Column, scale: Column, length: Column) -> Column:
    """Source mask, else the enumeration while it stays short, else by type."""
    kind = F.upper(data_type)
    members = string_members(allowed)
    listing = F.concat(F.lit("one of: "), F.array_join(F.slice(members, 1, 12), "|"),
                       F.when(F.size(members) > 12, "|…").otherwise(""))
    out = F.when(truthy(mask), mask).when(members.isNotNull() & (F.length(listing) <= 200), listing)
    for name, pattern in PATTERNS.items():
        out = out.when(kind == name, F.lit(pattern))
    decimals = F.concat(F.lit(r"^-?\d+(\.\d{1,"), scale.cast("string"), F.lit("})?$"))
    out = out.when(kind.isin("DECIMAL", "DOUBLE"), F.when(_positive(scale), decimals).otherwise(F.lit(r"^-?\d+$")))
    return out.when(kind.isin("VARCHAR", "TEXT", "OBJECT"), F.concat(F.lit("maxlength: "), length.cast("string")))


def entity_bucket(entity: Column) -> Column:
    """``catalog``, ``noise`` (dialog and junction models) or ``entity``."""
    words = "|".join(WIZARD_WORDS)
    return (F.when(entity == CATALOG_ENTITY, "catalog")
            .when(F.rlike(entity, F.lit(rf"(^|\.)({words})(\.|$)")), "noise")
            .when(F.rlike(entity, F.lit(r"_[^.]*\.")), "noise")
            .otherwise("entity"))


def ui_group(name: Column) -> Column:
    entity = entity_of(name)
    return F.when(entity_bucket(entity) == "noise", F.lit(WIZARD_GROUP)).otherwise(entity)


def ui_field_name(name: Column, group: Column) -> Column:
    return (F.when(group == WIZARD_GROUP, name)
            .when(F.startswith(name, F.concat(group, F.lit("."))), F.substr(name, F.length(group) + 2))
            .otherwise(field_of(name)))


def _filled(template: str, length: Column, scale: Column) -> Column:
    if "%n" in template:
        head, tail = template.split("%n")
        return F.concat(F.lit(head), length.cast("string"), F.lit(tail))
    if "%s" in template:
        head, tail = template.split("%s")
        return F.concat(F.lit(head), scale.cast("string"), F.lit(tail))
    return F.lit(template)


def dialect_type(dialect: str, data_type: Column, byte_length: Column, scale: Column, is_fk: Column) -> Column:
    """Column type in one SQL dialect; foreign keys are integers."""
    i = DIALECTS.index(dialect)
    length = F.when(byte_length.between(1, 65535), byte_length).otherwise(255)
    digits = F.coalesce(scale, F.lit(2))
    out = F.when(is_fk, F.lit(KEY_TYPES[i]))
    for kind, types in COLUMN_TYPES.items():
        out = out.when(data_type == kind, _filled(types[i], length, digits))
    return out.otherwise("TEXT")


def plain_type(data_type: Column, byte_length: Column, scale: Column) -> Column:
    """Column type of the plain table text: any non-zero declared length is taken."""
    length = F.when(byte_length != 0, byte_length).otherwise(255)
    out = F.when(F.lit(False), F.lit("TEXT"))
    for kind, template in PLAIN_TYPES.items():
        out = out.when(data_type == kind, _filled(template, length, F.coalesce(scale, F.lit(2))))
    return out.otherwise("TEXT")


def enum_check(column: Column, allowed: Column) -> Column:
    """``CHECK (col IN (...))`` for short lists of texts, else NULL."""
    quoted = F.array_join(
        F.transform(string_members(allowed), lambda v: F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'"))),
        ", ")
    return F.when(F.length(quoted) <= 110, F.concat(F.lit("CHECK ("), column, F.lit(" IN ("), quoted, F.lit("))")))


def coverage_grade(percent: Column) -> Column:
    out = F.when(F.lit(False), F.lit(LOWEST_COLOUR))
    for floor, colour in COVERAGE_COLOURS:
        out = out.when(percent >= floor, F.lit(colour))
    return out.otherwise(LOWEST_COLOUR)
