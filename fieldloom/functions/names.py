"""Name functions: casing, splitting, identifiers, display names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _split_humps(c: Column) -> Column:
    c = F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2")
    return F.regexp_replace(c, "([A-Z]+)([A-Z][a-z])", "$1_$2")


def _humps(c: Column) -> Column:
    """Lower-case words joined by single underscores, dots left alone."""
    return F.lower(F.regexp_replace(F.translate(_split_humps(c), " -", "__"), "_+", "_"))


def snake_case(c: Column) -> Column:
    """One token: ``GTINCode`` -> ``gtin_code``, `` a--B_ `` -> ``a_b``."""
    return F.regexp_replace(_humps(F.regexp_replace(c, r"^\s+|\s+$", "")), "^_+|_+$", "")


def snake_dotted(c: Column) -> Column:
    """Every dot-separated segment in snake case.

    The blanks and underscores around a dot are trimmed by one expression over
    the whole name, which stays in generated code; splitting, transforming and
    joining an array would not. A name without blanks, hyphens and underscores has
    nothing to trim: underscores come between letters and digits alone.
    """
    trimmed = _humps(F.regexp_replace(c, r"^\s+|\s+$|\s*(\.)\s*", "$1"))
    return F.when(F.rlike(c, F.lit(r"[\s_-]")), F.regexp_replace(trimmed, r"^_+|_+$|_*(\.)_*", "$1")).otherwise(F.lower(_split_humps(c)))


def has_dot(name: Column) -> Column:
    return F.instr(name, ".") > 0


def entity_of(name: Column) -> Column:
    """Text before the last dot; the whole name when there is none."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def entity_or_blank(name: Column) -> Column:
    """Text before the last dot; empty when there is none."""
    return F.when(has_dot(name), entity_of(name)).otherwise(F.lit(""))


def field_of(name: Column) -> Column:
    """Text after the last dot."""
    return F.substring_index(name, ".", -1)


def after_first_dot(name: Column) -> Column:
    """Text after the first dot: how column names of a table are cut."""
    return F.when(has_dot(name), F.substr(name, F.instr(name, ".") + 1)).otherwise(name)


def identifier(c: Column) -> Column:
    """Table or column identifier: lower case, other characters -> ``_``."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^0-9a-z]+", "_"), "^_+|_+$", "")


def humanize(entity: Column, display: Mapping[str, str] | None = None) -> Column:
    """Display name: a given one, else words with the first letter raised."""
    words = F.trim(F.translate(entity, "._", "  "))
    plain = F.concat(F.upper(F.substring(words, 1, 1)), F.lower(F.substr(words, F.lit(2))))
    if not display:
        return plain
    pairs = [F.lit(x) for kv in display.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), entity), plain)
