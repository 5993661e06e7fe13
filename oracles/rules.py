"""Oracles for row-level functions, reports and enrichment."""

from fieldloom.plans.rule_queries import DISPLAY_NAMES

from .base import build, define, entity, field, identifier, lookup, snake_all, whole_entity

ENT = whole_entity("name")
REST = "CASE WHEN contains(name, '.') THEN substr(name, strpos(name, '.') + 1) ELSE name END"
WIZARD = "['ask', 'start', 'result', 'preview', 'context', 'default', 'show']"
TARGET_LIST = r"""list_filter(list_transform(string_split(regexp_extract(description,
 '\((?:links to|references)\s+([^)]*)\)', 1, 'i'), ','), lambda t: trim(t)), lambda t: t <> '')"""
TARGET = f"CASE WHEN len({TARGET_LIST}) = 1 THEN {identifier(TARGET_LIST + '[1]')} END"
COLLECTION = "coalesce(contains(lower(description), 'collection of'), false)"
TEXTS = """CASE WHEN allowed_values LIKE '[%' THEN from_json(allowed_values, '["VARCHAR"]') END"""


def human(e: str) -> str:
    words = f"trim(replace(replace({e}, '.', ' '), '_', ' '))"
    return lookup(e, DISPLAY_NAMES, f"upper({words}[1]) || lower({words}[2:])")


def bucket(e: str) -> str:
    return f"""CASE WHEN {e} = 'gs1' THEN 'catalog' WHEN list_has_any(string_split({e}, '.'), {WIZARD}) THEN 'noise'
 WHEN len(list_filter(string_split({e}, '.')[:-2], lambda s: contains(s, '_'))) > 0 THEN 'noise' ELSE 'entity' END"""


LENGTH = """CAST(CASE WHEN data_type = 'VARCHAR' THEN CASE WHEN byte_length > 0 THEN byte_length ELSE 255 END
 WHEN data_type IN ('TEXT', 'OBJECT') THEN 4000 WHEN data_type = 'INTEGER' THEN 11 WHEN data_type = 'BIGINT' THEN 20
 WHEN data_type IN ('DECIMAL', 'DOUBLE') THEN CASE WHEN decimal_scale > 0 THEN 20 ELSE 19 END
 WHEN data_type = 'BOOLEAN' THEN 5 WHEN data_type = 'DATE' THEN 10 WHEN data_type = 'DATETIME' THEN 25 WHEN data_type = 'TIME' THEN 8
 WHEN data_type = 'RELATION' THEN 64 WHEN data_type = 'BLOB' THEN 8000 ELSE 255 END AS INT)"""
LISTING = "'one of: ' || array_to_string(texts[1:12], '|') || CASE WHEN len(texts) > 12 THEN '|…' ELSE '' END"
SPEC = rf"""CASE WHEN format_mask <> '' THEN format_mask WHEN len(texts) > 0 AND length({LISTING}) <= 200 THEN {LISTING}
 WHEN data_type = 'DATE' THEN '^\d{{4}}-\d{{2}}-\d{{2}}$' WHEN data_type = 'DATETIME' THEN '^\d{{4}}-\d{{2}}-\d{{2}}[ T]\d{{2}}:\d{{2}}(:\d{{2}})?'
 WHEN data_type = 'TIME' THEN '^\d{{2}}:\d{{2}}(:\d{{2}})?$' WHEN data_type = 'BOOLEAN' THEN '^(true|false|0|1)$'
 WHEN data_type IN ('INTEGER', 'BIGINT') THEN '^-?\d+$'
 WHEN data_type IN ('DECIMAL', 'DOUBLE') THEN CASE WHEN decimal_scale > 0 THEN '^-?\d+(\.\d{{1,' || decimal_scale || '}})?$' ELSE '^-?\d+$' END
 WHEN data_type = 'RELATION' THEN 'key reference' WHEN data_type IN ('VARCHAR', 'TEXT', 'OBJECT') THEN 'maxlength: ' || char_length END"""
VALUES = f"""CASE WHEN allowed_values LIKE '[%' THEN from_json(allowed_values, '["VARCHAR"]')
 WHEN allowed_values LIKE '{{%' THEN flatten(list_transform(json_keys(allowed_values),
  lambda k: from_json(json_extract(allowed_values, '$."' || k || '"'), '["VARCHAR"]'))) END"""
SYNTH = f"""{human('ent')} || ': ' || trim(coalesce(nullif(title, ''), {field('name')})) || '.' ||
 CASE WHEN len(vs) > 0 THEN ' Allowed values: ' || array_to_string(shown[1:12], ', ') ||
  CASE WHEN len(shown) > 12 THEN ', ... (+' || (len(shown) - 12) || ' more)' ELSE '' END || '.' ELSE '' END"""
def synth_from(items: str) -> str:
    return f"""(SELECT *, list_filter(vs, lambda v, i: v <> '' AND list_position(vs, v) = i) AS shown FROM
 (SELECT *, {ENT} AS ent, {VALUES} AS vs FROM {items}))"""


SYNTH_FROM = synth_from("clean")
BLANK = "trim(coalesce(description, '')) = ''"

define("overridden", ["clean", "curated"], """
SELECT c.* REPLACE (coalesce(u.description, c.description) AS description),
 coalesce(u.description, c.description) IS DISTINCT FROM c.description AS changed FROM clean c LEFT JOIN curated u USING (name)""")
define("finished", ["overridden"], f"""
SELECT category, name, CASE WHEN {BLANK} THEN {SYNTH} ELSE description END AS description FROM {synth_from('overridden')}""")
define("cover", ["overridden", "curated"], f"""
SELECT CASE WHEN grouping(category) = 1 THEN 'All' ELSE category END AS category, count(*) AS items,
 count(*) FILTER (NOT ({BLANK}) AND NOT cur) AS from_source, count(*) FILTER (NOT ({BLANK}) AND cur) AS curated,
 count(*) FILTER ({BLANK}) AS missing FROM (
 SELECT o.category, o.description, coalesce(o.description = u.description, false) AS cur FROM overridden o LEFT JOIN curated u USING (name))
GROUP BY ROLLUP (category)""")
PERCENT = "CAST(100.0 AS DOUBLE) * CAST(from_source + curated AS DOUBLE) / CAST(items AS DOUBLE)"
define("atoms", ["clean"], """
SELECT category, trim(unnest(string_split(source_standard, ';'))) AS source FROM clean""")
define("raw_entities", ["raw_items"], f"SELECT DISTINCT {entity('d')} AS entity FROM (SELECT {snake_all('name')} AS d FROM raw_items)")


def dialect(i: int) -> str:
    pick = lambda a, b, c: "'" + (a, b, c)[i] + "'"
    return f"""CASE WHEN ({TARGET}) IS NOT NULL THEN {pick('INTEGER', 'INTEGER', 'INT')}
 WHEN data_type = 'VARCHAR' THEN 'VARCHAR(' || CASE WHEN byte_length BETWEEN 1 AND 65535 THEN byte_length ELSE 255 END || ')'
 WHEN data_type IN ('INTEGER', 'RELATION') THEN {pick('INTEGER', 'INTEGER', 'INT')}
 WHEN data_type = 'DECIMAL' THEN 'DECIMAL(18,' || coalesce(decimal_scale, 2) || ')'
 WHEN data_type = 'BOOLEAN' THEN {pick('BOOLEAN', 'BOOLEAN', 'TINYINT(1)')} WHEN data_type = 'DATE' THEN 'DATE'
 WHEN data_type = 'DATETIME' THEN {pick('DATETIME', 'TIMESTAMP', 'DATETIME')} WHEN data_type = 'TIME' THEN 'TIME'
 WHEN data_type = 'OBJECT' THEN {pick('TEXT', 'JSONB', 'JSON')} WHEN data_type = 'BLOB' THEN {pick('BLOB', 'BYTEA', 'BLOB')} ELSE 'TEXT' END"""


def check_text(col: str) -> str:
    lits = "array_to_string(list_transform(texts, lambda v: '''' || replace(v, '''', '''''') || ''''), ', ')"
    return f"CASE WHEN len(texts) > 0 AND length({lits}) <= 110 THEN 'CHECK (' || {col} || ' IN (' || {lits} || '))' END"


def q(select: str, *needs: str) -> str:
    return build(list(needs) or ["clean"], select)


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
CELLS = ", ".join(f"CAST(count(*) FILTER (source = '{r}') AS BIGINT) AS \"{r}\"" for r in REGIONS)

ORACLES = {
    "split_entity_field": q(f"""SELECT category, name, {ENT} AS entity,
 CASE WHEN contains(name, '.') THEN {entity('name')} ELSE '' END AS namespace, {field('name')} AS field, {REST} AS column_path FROM clean"""),
    "identifier_norm": q(f"SELECT DISTINCT e AS entity, {identifier('e')} AS identifier FROM (SELECT {ENT} AS e FROM clean)"),
    "humanize_entity": q(f"SELECT DISTINCT e AS entity, {human('e')} AS display_name FROM (SELECT {ENT} AS e FROM clean)"),
    "synthesize_description": q(f"SELECT category, name, {SYNTH} AS description FROM {SYNTH_FROM} WHERE {BLANK}"),
    "allowed_values_parse": build(["raw_items"], """SELECT ord, CAST(i - 1 AS INT) AS pos, CAST(vs[i] AS VARCHAR) AS value FROM (
 SELECT ord, vs, unnest(range(1, len(vs) + 1)) AS i FROM (SELECT ord, json_extract(CAST(allowed_values AS JSON), '$[*]') AS vs FROM raw_items))"""),
    "relation_target": q(f"SELECT category, name, {TARGET} AS target FROM clean"),
    "is_collection": q(f"SELECT category, name, {COLLECTION} AS is_collection FROM clean"),
    "char_length_policy": q(f"SELECT category, name, {LENGTH} AS char_length FROM clean"),
    "validation_spec": q(f"SELECT category, name, {SPEC} AS validation_spec FROM (SELECT *, {TEXTS} AS texts, {LENGTH} AS char_length FROM clean)"),
    "entity_bucket": q(f"SELECT DISTINCT e AS entity, {bucket('e')} AS bucket FROM (SELECT {ENT} AS e FROM clean)"),
    "ui_field_name": q(f"""SELECT category, name, g AS group_name, CASE WHEN g = 'Wizard' THEN name ELSE {field('name')} END AS field_name
FROM (SELECT *, CASE WHEN {bucket('e')} = 'noise' THEN 'Wizard' ELSE e END AS g FROM (SELECT *, {ENT} AS e FROM clean))"""),
    "dialect_type": q(" UNION ALL ".join(
        f"SELECT category, name, '{d}' AS dialect, {dialect(i)} AS column_type FROM clean" for i, d in enumerate(("sqlite", "postgres", "mysql")))),
    "enum_check": q(f"""SELECT category, name, {check_text('col')} AS check_text
FROM (SELECT *, {identifier(REST)} AS col, {TEXTS} AS texts FROM clean) WHERE {check_text('col')} IS NOT NULL"""),
    "coverage_by_category": q(f"SELECT category, items, from_source, curated, missing, {PERCENT} AS percent FROM cover", "cover"),
    "coverage_grade": q(f"""SELECT category, percent, CASE WHEN percent >= 100 THEN 'brightgreen' WHEN percent >= 90 THEN 'green'
 WHEN percent >= 75 THEN 'yellowgreen' WHEN percent >= 50 THEN 'yellow' ELSE 'orange' END AS grade
FROM (SELECT category, {PERCENT} AS percent FROM cover)""", "cover"),
    "curated_override": q("SELECT category, name, description, changed FROM overridden", "overridden"),
    "finished_catalog": q("SELECT category, name, description FROM finished", "finished"),
    "check_finished": q(f"""SELECT 'missing_description' AS "check", count(*) FILTER ({BLANK}) AS bad, count(*) FILTER ({BLANK}) = 0 AS ok FROM finished""", "finished"),
    "backfill_descriptions": q(f"SELECT category, name, CASE WHEN {BLANK} THEN {SYNTH} ELSE description END AS description FROM {SYNTH_FROM}"),
    "longest_prefix_parent": q("""SELECT a.entity, first(b.entity ORDER BY length(b.entity) DESC) AS parent
FROM raw_entities a LEFT JOIN raw_entities b ON starts_with(a.entity, b.entity || '.') GROUP BY 1""", "raw_entities"),
    "source_category_matrix": q(f"""SELECT CASE WHEN grouping(category) = 1 THEN 'Total' ELSE category END AS category, {CELLS}, count(*) AS total
FROM atoms GROUP BY ROLLUP (category)""", "atoms"),
    "source_category_edges": q("""SELECT category, source, n, CAST(sum(n) OVER (PARTITION BY category) AS BIGINT) AS category_total
FROM (SELECT category, source, count(*) AS n FROM atoms GROUP BY 1, 2)""", "atoms"),
    "dictionary_stats": q("""SELECT g.name AS category, count(c.name) AS items, (SELECT count(*) FROM clean) AS data_items,
 (SELECT count(*) FROM categories) AS categories, (SELECT count(DISTINCT source) FROM atoms) AS source_standards
FROM categories g LEFT JOIN clean c ON c.category = g.name GROUP BY 1""", "clean", "categories", "atoms"),
}
