"""Allowed-value cells: JSON array, JSON object keyed by source, or plain text.

Members are handled as JSON fragments (``"a"``, ``1``, ``true``), so a number
stays a number and is never confused with the text that spells it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truthy(c: Column) -> Column:
    """Present and not the empty text."""
    return c.isNotNull() & (c != "")


def json_quote(c: Column) -> Column:
    """A text as a JSON string."""
    wrapped = F.to_json(F.array(c))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def _fragment(v: Column) -> Column:
    return F.coalesce(F.to_json(v), F.lit("null"))


def _starts(av: Column, pattern: str) -> Column:
    return F.rlike(av, F.lit(rf"^\s*{pattern}"))


# A failed parse is costly: texts that cannot be of a shape are not even tried.
def is_json_array(av: Column) -> Column:
    return F.when(_starts(av, r"\["), F.json_array_length(av)).isNotNull()


def is_json_object(av: Column) -> Column:
    return F.when(_starts(av, r"\{"), F.json_object_keys(av)).isNotNull()


def parse_allowed_values(av: Column) -> Column:
    """All members as an array of JSON fragments, in written order."""
    items = F.from_json(av, "array<variant>")
    per_source = F.map_values(F.from_json(av, "map<string,variant>"))
    flattened = F.flatten(
        F.transform(
            per_source,
            lambda v: F.when(
                F.schema_of_variant(v).startswith("ARRAY"),
                F.transform(F.variant_get(v, "$", "array<variant>"), _fragment),
            ).otherwise(F.array(_fragment(v))),
        )
    )
    scalar = F.when(_starts(av, r'(["0-9-]|true|false|null)'), F.try_parse_json(av))
    return (
        F.when(~truthy(av), F.expr("cast(array() AS array<string>)"))
        .when(is_json_array(av), F.transform(items, _fragment))
        .when(is_json_object(av), flattened)
        .when(scalar.isNotNull(), F.array(_fragment(scalar)))
        .otherwise(F.array(json_quote(av)))
    )


def display_values(av: Column) -> Column:
    """All members as plain text (strings without their quotes)."""
    return F.transform(parse_allowed_values(av), lambda f: F.get_json_object(F.concat(F.lit('{"v":'), f, F.lit("}")), "$.v"))


def string_members(av: Column) -> Column:
    """The members when the cell is a non-empty JSON array of texts only, else NULL."""
    fragments = F.when(is_json_array(av), F.transform(F.from_json(av, "array<variant>"), _fragment))
    only_text = (F.size(fragments) > 0) & F.forall(fragments, lambda f: f.startswith('"'))
    return F.when(fragments.isNotNull() & only_text, F.from_json(av, "array<string>"))


def join_non_empty(values: Column, separator: str) -> Column:
    """Joined text, NULL for an empty list."""
    return F.when(F.size(values) > 0, F.array_join(values, separator))
