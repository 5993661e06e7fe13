"""Oracles for normalization, aliases and the survivorship merge."""

from .base import build, define, field, entity, snake

define("members", ["clean"], f"""
SELECT category, {field('name')} AS field, CASE WHEN contains(name, '.') THEN {entity('name')} ELSE '' END AS entity,
 unnest(string_split(coalesce(source_standard, ''), '; ')) AS source FROM clean""")
define("related", ["members"], """
SELECT category, field, string_agg(DISTINCT entity, ', ' ORDER BY entity) AS entities,
 string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM members GROUP BY 1, 2
HAVING count(DISTINCT entity) > 1 AND count(DISTINCT source) > 1""")

MULTI = "WHERE n_members > 1"
CATALOG = ("category, name, title, description, data_type, byte_length, decimal_scale, is_required, is_nullable, default_value, "
           "allowed_values, format_mask, source_standard, source_url, version, first_ord, n_members, n_sources")

ORACLES = {
    "group_concepts": build(["norm"], """
SELECT category, name, count(*) AS n_members, count(DISTINCT source_standard) AS n_sources FROM norm GROUP BY ALL"""),
    "merge_primary": build(["clean_core"], f"""
SELECT category, name, n_members, data_type, decimal_scale, CAST(NULL AS VARCHAR) AS default_value, format_mask FROM clean_core {MULTI}"""),
    "merge_description": build(["clean_core"], f"SELECT category, name, n_members, description FROM clean_core {MULTI}"),
    "merge_title": build(["clean"], f"SELECT category, name, n_members, title FROM clean {MULTI}"),
    "merge_byte_length": build(["clean_core"], f"SELECT category, name, n_members, byte_length FROM clean_core {MULTI}"),
    "merge_required": build(["clean_core"], f"""
SELECT category, name, n_members, is_required, NOT is_required AS is_nullable FROM clean_core {MULTI}"""),
    "merge_provenance": build(["clean"], f"""
SELECT category, name, n_members, source_standard, source_url, version FROM clean {MULTI}"""),
    "merge_allowed_values": build(["clean"], f"SELECT category, name, n_members, allowed_values FROM clean {MULTI}"),
    "merged_catalog": build(["clean"], f"SELECT {CATALOG} FROM clean"),
    "merge_report": build(["clean"], """
SELECT category, name, source_standard AS sources, n_members AS count FROM clean WHERE n_sources > 1"""),
    "related_concepts": build(["related"], "SELECT category, field, entities, sources FROM related"),
    "merge_summary": build(["raw_items", "clean", "related"], """
SELECT (SELECT count(*) FROM raw_items) AS input_items, (SELECT count(*) FROM clean) AS output_items,
 (SELECT count(*) FROM clean WHERE n_sources > 1) AS merged_concepts, (SELECT count(*) FROM related) AS related_concepts"""),
    "entity_alias_report": build(["resolved"], """
SELECT source_entity, canonical_entity AS canonical, count(*) AS items FROM resolved
WHERE canonical_entity <> source_entity GROUP BY 1, 2"""),
    "field_alias_report": build(["resolved"], """
SELECT base_name AS source_field, canonical_field AS canonical, count(*) AS items FROM resolved
WHERE canonical_field IS NOT NULL GROUP BY 1, 2"""),
    "entity_alias_join": build(["resolved"], """
SELECT ord, name, source_entity, coalesce(canonical_entity, source_entity) AS entity FROM resolved"""),
    "field_alias_join": build(["resolved"], """
SELECT ord, base_name, coalesce(canonical_field, base_name) AS name FROM resolved"""),
    "snake_case": build(["raw_items"], f"SELECT ord, name, {snake('name')} AS snake_name FROM raw_items"),
    "normalize_name": build(["norm"], "SELECT n.ord, r.name AS raw_name, n.name FROM norm n JOIN raw_items r USING (ord)"),
    "completeness_score": build(["norm"], "SELECT ord, CAST(score AS INT) AS score FROM norm"),
}
