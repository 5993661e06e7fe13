"""Oracles for the cookbook."""

from .base import build, field, whole_entity


def q(select: str, *more: str) -> str:
    return build(["clean", *more], select)


COUNTS = "SELECT g.name AS category, count(c.name) AS items FROM categories g LEFT JOIN clean c ON c.category = g.name GROUP BY 1"

ORACLES = {
    "items_with_category": q("SELECT c.category, c.name, c.source_standard, g.category_id FROM clean c JOIN categories g ON g.name = c.category",
                             "categories"),
    "category_left_counts": q(COUNTS, "categories"),
    "q_category_counts": q(COUNTS + " ORDER BY 2 DESC, 1", "categories"),
    "q_headline_totals": q("SELECT (SELECT count(*) FROM clean) AS data_items, (SELECT count(*) FROM categories) AS categories", "categories"),
    "q_category_lookup": build(["categories"], "SELECT category_id, name FROM categories WHERE name = 'MACHINERY'"),
    "q_items_in_category": q("SELECT name, title, data_type, is_required FROM clean WHERE category = 'MACHINERY' ORDER BY name"),
    "q_entity_fields": q("SELECT category, name, data_type, byte_length, description FROM clean WHERE name LIKE 'invoice.%'"),
    "q_keyword": q("SELECT category, name, title, source_standard FROM clean WHERE name ILIKE '%gtin%' OR title ILIKE '%gtin%' OR description ILIKE '%gtin%'"),
    "q_entity_field_counts": q(f"SELECT {whole_entity('name')} AS entity, count(*) AS fields FROM clean WHERE contains(name, '.') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"),
    "q_type_distribution": q("SELECT data_type, count(*) AS n FROM clean GROUP BY 1"),
    "q_required_only": q("SELECT category, name, data_type, byte_length FROM clean WHERE is_required"),
    "q_longest_strings": q("SELECT category, name, byte_length FROM clean WHERE data_type = 'VARCHAR' AND byte_length IS NOT NULL ORDER BY byte_length DESC, name, category LIMIT 20"),
    "q_has_enum": q("SELECT category, name, allowed_values FROM clean WHERE allowed_values IS NOT NULL"),
    "q_divergent_enum": q("SELECT category, name, source_standard, allowed_values FROM clean WHERE allowed_values LIKE '{%}'"),
    "q_enum_expand": q("""SELECT category, name, unnest(from_json(allowed_values, '["VARCHAR"]')) AS allowed_value FROM clean WHERE allowed_values LIKE '[%]'"""),
    "q_enum_expand_by_source": q("""SELECT category, name, source, unnest(from_json(json_extract(allowed_values, '$."' || source || '"'), '["VARCHAR"]')) AS allowed_value
FROM (SELECT *, unnest(json_keys(allowed_values)) AS source FROM clean WHERE allowed_values LIKE '{%}')"""),
    "q_items_per_source": q("SELECT source, count(*) AS items FROM (SELECT trim(unnest(string_split(source_standard, ';'))) AS source FROM clean) GROUP BY 1"),
    "q_one_source": q("SELECT category, name, data_type FROM clean WHERE source_standard LIKE '%EUROPE%'"),
    "q_trace_item": q("SELECT category, name, source_standard, source_url, version FROM clean WHERE name = 'invoice.cust_key1'"),
    "q_corroborated": q("SELECT category, name, source_standard, CAST(length(source_standard) - length(replace(source_standard, ';', '')) + 1 AS INT) AS n_sources FROM clean WHERE source_standard LIKE '%;%'"),
    "q_corroborated_by_category": q("SELECT category, count(*) AS corroborated FROM clean WHERE source_standard LIKE '%;%' GROUP BY 1"),
    "q_format_masks": q("SELECT category, name, data_type, format_mask FROM clean WHERE format_mask IS NOT NULL"),
    "q_source_catalog": q("SELECT category, name, title, format_mask, byte_length FROM clean WHERE source_standard LIKE '%EUROPE%'"),
    "q_missing_description": q("SELECT count(*) AS missing_description FROM clean WHERE coalesce(description, '') = ''"),
    "q_category_coverage": q("""SELECT category, count(*) AS items, count(*) FILTER (coalesce(description, '') <> '') AS with_desc,
 count(allowed_values) AS with_enum, count(*) FILTER (is_required) AS required FROM clean GROUP BY 1"""),
    "q_shared_fields": q(f"""SELECT category, {field('name')} AS field, count(DISTINCT source_standard) AS sources, count(*) AS occurrences
FROM clean GROUP BY 1, 2 HAVING count(*) > 1 AND count(DISTINCT source_standard) > 1 ORDER BY occurrences DESC, category, field LIMIT 20"""),
}
