"""Oracles for the interface projection and the checks."""

from .base import build, define, field, whole_entity
from .rules import BLANK, LENGTH, SPEC, TEXTS, bucket

ENT = whole_entity("name")
define("ui_base", ["clean"], f"""
SELECT *, CASE WHEN {bucket('e')} = 'noise' THEN 'Wizard' ELSE e END AS g FROM (
 SELECT *, {ENT} AS e, {TEXTS} AS texts, {LENGTH} AS char_length FROM clean)""")
define("ui_sources", ["ui_base"], """
SELECT g, string_agg(source, '; ' ORDER BY first_ord, name, i) AS source FROM (
 SELECT *, row_number() OVER (PARTITION BY g, source ORDER BY first_ord, name, i) AS rn FROM (
  SELECT g, first_ord, name, i, trim(ss[i]) AS source FROM (
   SELECT g, first_ord, name, ss, unnest(range(1, len(ss) + 1)) AS i FROM (
    SELECT g, first_ord, name, string_split(source_standard, ';') AS ss FROM ui_base))) WHERE source <> '') WHERE rn = 1 GROUP BY g""")
define("ui_parents", ["ui_base"], """
SELECT a.e AS g, first(b.e ORDER BY length(b.e) DESC) AS parent FROM (SELECT DISTINCT e FROM ui_base) a
JOIN (SELECT DISTINCT e FROM ui_base) b ON starts_with(a.e, b.e || '.') GROUP BY 1""")
define("ui_groups", ["ui_base", "ui_sources", "ui_parents", "categories"], """
SELECT row_number() OVER (ORDER BY m.g) AS group_id, m.g AS group_name, k.category_id,
 CASE WHEN m.g = 'Wizard' THEN 'Transient wizard and junction (relation) models, grouped together; Name keeps the full source path.'
  WHEN m.g = 'gs1' THEN 'GS1 Application Identifier catalog.'
  WHEN p.parent IS NOT NULL THEN 'Component (sub-entity) of ' || p.parent || '.' END AS description, s.source
FROM (SELECT g, first(category ORDER BY n DESC, category) AS category FROM (
  SELECT g, category, count(*) AS n FROM ui_base GROUP BY 1, 2) GROUP BY 1) m
LEFT JOIN ui_sources s USING (g) LEFT JOIN ui_parents p USING (g) LEFT JOIN categories k ON k.name = m.category""")
define("ui", ["ui_base", "ui_groups"], f"""
SELECT u.group_id, CASE WHEN g = 'Wizard' THEN name ELSE {field('name')} END AS name, title, b.description, data_type, char_length,
 char_length * 4 AS byte_length, decimal_scale, is_required, is_nullable, default_value, allowed_values,
 {SPEC} AS validation_specs, version FROM ui_base b JOIN ui_groups u ON u.group_name = b.g""")


def bad(name: str, count: str) -> str:
    return f"SELECT '{name}' AS \"check\", CAST(bad AS BIGINT) AS bad, bad = 0 AS ok FROM (SELECT {count} AS bad)"


CHECKS = {
    "check_nonempty": [("items_nonempty", "CASE WHEN EXISTS (SELECT 1 FROM clean) THEN 0 ELSE 1 END"),
                       ("categories_nonempty", "CASE WHEN EXISTS (SELECT 1 FROM categories) THEN 0 ELSE 1 END")],
    "check_description": [("missing_description", f"(SELECT count(*) FROM clean WHERE {BLANK})")],
    "check_empty_category": [("empty_category", "(SELECT count(*) FROM categories c WHERE NOT EXISTS (SELECT 1 FROM clean d WHERE d.category = c.name))")],
    "check_orphan_curated": [("orphan_curated", "(SELECT count(*) FROM curated c WHERE NOT EXISTS (SELECT 1 FROM clean d WHERE d.name = c.name))")],
    "check_ui_complete": [("ui_item_count", "abs((SELECT count(*) FROM ui) - (SELECT count(*) FROM clean))"),
                          ("ui_groups_nonempty", "CASE WHEN EXISTS (SELECT 1 FROM ui_groups) THEN 0 ELSE 1 END")],
    "check_ui_lengths": [("ui_byte_length", "(SELECT count(*) FROM ui WHERE byte_length IS DISTINCT FROM char_length * 4)"),
                         ("ui_char_length", "(SELECT count(*) FROM ui WHERE char_length IS NULL OR char_length <= 0)")],
    "check_unique_key": [
        ("duplicate_natural_key", "(SELECT count(*) FROM (SELECT 1 FROM clean GROUP BY category, name, source_standard HAVING count(*) > 1))"),
        ("duplicate_ui_key", "(SELECT count(*) FROM (SELECT 1 FROM ui GROUP BY group_id, name HAVING count(*) > 1))")],
    "check_ui_fk": [("ui_item_without_group", "(SELECT count(*) FROM ui x WHERE NOT EXISTS (SELECT 1 FROM ui_groups g WHERE g.group_id = x.group_id))"),
                    ("ui_group_without_category", "(SELECT count(*) FROM ui_groups g WHERE NOT EXISTS (SELECT 1 FROM categories c WHERE c.category_id = g.category_id))")],
}
NEEDS = ["clean", "categories", "curated", "ui", "ui_groups"]

ORACLES = {
    "ui_groups": build(["ui_groups"], "SELECT group_id, group_name, category_id, description, source FROM ui_groups"),
    "ui_items": build(["ui"], "SELECT * FROM ui"),
    "missing_group_anti": build(["ui", "ui_groups"], "SELECT group_id, name FROM ui WHERE group_id NOT IN (SELECT group_id FROM ui_groups)"),
    **{key: build(NEEDS, " UNION ALL ".join(bad(*c) for c in checks)) for key, checks in CHECKS.items()},
    "check_report": build(NEEDS, " UNION ALL ".join(bad(*c) for checks in CHECKS.values() for c in checks)),
    "missing_group_damaged": build(["ui"], "SELECT group_id, name FROM ui WHERE group_id % 5 = 0"),
    "check_damaged_copy": build(["clean"], """
SELECT category, name, title, 'first' AS only_in FROM clean WHERE first_ord % 7 = 0 OR first_ord % 11 = 0
UNION ALL SELECT category, name, coalesce(title, '') || '!', 'second' FROM clean WHERE first_ord % 7 > 0 AND first_ord % 11 = 0
UNION ALL SELECT category, name, CASE WHEN first_ord % 11 = 0 THEN coalesce(title, '') || '!' ELSE title END, 'second'
 FROM clean WHERE first_ord % 7 > 0 AND first_ord % 13 = 0"""),
    "check_idempotent": build(["clean"], "SELECT *, 'first' AS only_in FROM clean WHERE false"),
}
# The same checks on the catalog as it is delivered; the projection shows its items.
ORACLES["check_report_finished"] = build([*NEEDS, "finished"], " UNION ALL ".join(
    bad(name, count if name == "duplicate_natural_key" else count.replace("FROM clean", "FROM finished")) for checks in CHECKS.values() for name, count in checks))
