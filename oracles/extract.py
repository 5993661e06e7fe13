"""Oracles for loading, extraction and files."""

from fieldloom.sources.speclines import CATEGORY_RULES, DEFAULT_CATEGORY, INTERNAL_CODES
from fieldloom.sources.typemaps import CDM, DEFAULTS, FHIR, TYPE_MAPS, VOCABULARY
from fieldloom.sources.tables import view_sql

from .base import CTES, FIELD_ALIASES, build, define, lookup, merged
from .merge import CATALOG

define("declared", [], f"SELECT * FROM ({view_sql('declared')}) WHERE is_declared")


def mapped(x: str, types: dict[str, str], default: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in types.items()) + f" ELSE {default} END"


KINDS = {"AFRICA": "cdm", "AMERICA": "odoo", "ASIA": "tryton", "EUROPE": "fhir", "MIDDLE EAST": "openapi"}
LAST = lambda col, where: f"first({col} ORDER BY source DESC) FILTER ({col} IS NOT NULL{where})"
CDM_NATIVE = "CASE native_type WHEN 'Data' THEN 'string' WHEN 'Int' THEN 'integer' WHEN 'Currency' THEN 'currency' WHEN 'Link' THEN 'partyLink' END"
define("attrs", ["line_fields"], f"""
SELECT doc_id, line_no, entity, fieldname AS attribute, fieldname AS title, native_type = 'Select' AS is_option_set,
 CASE WHEN native_type = 'Select' THEN 'INTEGER' ELSE {mapped(CDM_NATIVE, CDM, "'VARCHAR'")} END AS data_type,
 max_len AS byte_length, reqd AS is_required,
 nullif(trim(CASE WHEN reqd THEN 'Line ' || line_no ELSE '' END || CASE WHEN native_type = 'Select' THEN ' Option-set (enumerated integer codes).' ELSE '' END), '') AS description
FROM line_fields WHERE fieldname IS NOT NULL AND native_type <> 'Section Break'
UNION ALL SELECT doc_id, line_no, entity, 'rowVersion', 'rowVersion', false, 'BIGINT', NULL, false, NULL FROM line_fields""")
define("props", ["event_props"], """
SELECT event_id, 'k' || (event_id % 3) AS title, event_id % 7 AS kind, json_keys(CASE WHEN event_id % 2 = 0
 THEN json_extract(doc, '$.components.schemas') ELSE json_extract(doc, '$.definitions') END)[1] AS schema_name FROM event_props""")
PROP_TYPE = """CASE kind WHEN 0 THEN 'DATETIME' WHEN 1 THEN 'INTEGER' WHEN 2 THEN 'DECIMAL' WHEN 3 THEN 'RELATION'
 WHEN 4 THEN 'RELATION' ELSE 'VARCHAR' END"""
define("spec", ["spec_lines"], r"""
SELECT ord, code, trim(title) AS title, array_to_string(CASE WHEN cut > 1 THEN rest[1:cut - 1] WHEN cut = 1 THEN [] ELSE rest END, ' ') AS spec FROM (
 SELECT *, coalesce(list_position(list_transform(rest, lambda t: contains(t, '=') OR t = 'dlpkey'), true), 0) AS cut FROM (
  SELECT ord, title, tokens[1] AS code,
   CASE WHEN regexp_full_match(tokens[2], '[*?]+') THEN tokens[3:] ELSE tokens[2:] END AS rest FROM (
   SELECT ord, substr(line, strpos(line, '#') + 1) AS title,
    list_filter(regexp_split_to_array(split_part(line, '#', 1), '\s+'), lambda t: t <> '') AS tokens
   FROM spec_lines WHERE contains(line, '#') AND NOT starts_with(ltrim(line), '#')) WHERE len(tokens) > 0))""")
define("spec_ok", ["spec"], f"""
SELECT *, CAST(coalesce(nullif(regexp_replace(split_part(code, '-', 1), '[^0-9]', '', 'g'), ''), '-1') AS BIGINT) AS n,
 split_part(code, '-', 1) AS a FROM spec WHERE spec <> '' AND split_part(code, '-', 1) NOT IN ({', '.join(repr(c) for c in INTERNAL_CODES)})""")
SPEC_TYPE = """CASE WHEN contains(lower(spec), 'yymmd') AND (contains(lower(spec), 'hhmi') OR contains(lower(spec), 'hhmm')) THEN 'DATETIME'
 WHEN contains(lower(spec), 'yymmd') THEN 'DATE' WHEN n BETWEEN 3100 AND 3699 OR n BETWEEN 3900 AND 3949 THEN 'DECIMAL' ELSE 'VARCHAR' END"""
RULES = " ".join(
    "WHEN a IN (" + ", ".join(repr(c) for c in codes) + ")" + "".join(f" OR n BETWEEN {lo} AND {hi}" for lo, hi in ranges) + f" THEN '{cat}'"
    for cat, codes, ranges in CATEGORY_RULES)
SLUG = "coalesce(nullif(trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'ai')"
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
PLAIN = lambda x: f"nullif(trim(regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '{WS}', ' ', 'g')), '')"
LINK = r'(?s)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>'
define("closure", ["part_tree"], """
SELECT node, node AS ancestor FROM part_tree UNION
SELECT c.node, t.parent AS ancestor FROM closure c JOIN part_tree t ON t.node = c.ancestor WHERE t.parent IS NOT NULL""")
ROUTE = "CASE WHEN e IN ('Invoice', 'account.invoice') THEN 'Finance' WHEN e IN ('order', 'sale.sale') THEN 'Sales' ELSE 'Common' END"
RAW_ENTITY = "array_to_string(string_split(name, '.')[:-2], '.')"
CODES = "string_split(codes, '|')"
TARGETS = "list_sort(list_distinct(list_transform(string_split(target_profiles, '|'), lambda t: string_split(t, '/')[-1])))"
RANGES = "string_split(ranges, '|')"
NAMED = f"list_transform({RANGES}, lambda r: string_split(r, ':')[-1])"
PRIMITIVE = mapped("lower(string_split(c, '.')[-1])", FHIR)

ORACLES = {
    "load_sources": build(["raw_items"], """
SELECT ord, category, name, CASE WHEN source_standard <> 'ASIA' THEN title END AS title,
 CASE WHEN source_standard <> 'ASIA' THEN format_mask END AS format_mask, CAST(NULL AS VARCHAR) AS default_value,
 CASE WHEN source_standard <> 'AFRICA' THEN version END AS version, source_standard FROM raw_items"""),
    "derive_categories": build(["declared", "raw_items"], f"""
SELECT name, {LAST('description', '')} AS description, {LAST('source', '')} AS source FROM declared GROUP BY 1
UNION ALL SELECT DISTINCT category, NULL, NULL FROM raw_items WHERE category NOT IN (SELECT name FROM declared)"""),
    "upsert_categories": build(["declared"], f"""
SELECT coalesce(d.name, b.name) AS name, coalesce(d.description, b.description) AS description, coalesce(d.source, b.source) AS source
FROM (SELECT name, {LAST('description', '')} AS description, max(source) AS source FROM declared WHERE source IN ('AFRICA', 'AMERICA', 'MIDDLE EAST') GROUP BY 1) b
FULL JOIN (SELECT name, {LAST('description', '')} AS description, max(source) AS source FROM declared WHERE source IN ('ASIA', 'EUROPE') GROUP BY 1) d
ON b.name = d.name"""),
    "json_entity_attrs": build(["attrs"], "SELECT doc_id, line_no, entity, attribute, title, data_type, byte_length, is_required FROM attrs"),
    "optionset_flag": build(["attrs"], "SELECT doc_id, line_no, attribute, is_option_set, description FROM attrs"),
    "json_field_list": build(["line_fields"], """
SELECT doc_id, line_no, entity, entity || '.' || fieldname AS name, fieldname AS title,
 CASE WHEN native_type = 'Link' THEN '(links to ' || options || ')' END AS description,
 CASE native_type WHEN 'Int' THEN 'INTEGER' WHEN 'Currency' THEN 'DECIMAL' ELSE 'VARCHAR' END AS data_type,
 nullif(max_len - 1, 0) AS byte_length, reqd AS is_required,
 CASE WHEN native_type = 'Select' THEN '["' || replace(options, '|', '","') || '"]' END AS allowed_values
FROM line_fields WHERE fieldname IS NOT NULL AND native_type <> 'Section Break'"""),
    "json_schema_props": build(["props"], f"""
SELECT event_id, schema_name, schema_name || '.' || title AS name, title,
 CASE WHEN kind = 6 THEN 'untyped' END AS description, {PROP_TYPE} AS data_type, CASE WHEN kind = 1 THEN 9 END AS byte_length,
 title = 'k1' AS is_required, CASE WHEN kind = 5 THEN '["a","b"]' END AS allowed_values FROM props"""),
    "anyof_type_resolve": build(["props"], f"SELECT event_id, schema_name || '.' || title AS name, {PROP_TYPE} AS data_type FROM props"),
    "json_path_elements": build(["line_fields"], r"""
SELECT doc_id, line_no, entity || '.' || fieldname AS name, fieldname AS title, CASE WHEN note IS NULL THEN d WHEN d IS NULL THEN note
 ELSE d || ' (' || note || ')' END AS description, data_type, reqd AS is_required FROM (
 SELECT *, CASE WHEN max_len % 3 > 0 THEN 'Up to ' || max_len END AS d,
  CASE native_type WHEN 'Int' THEN 'INTEGER' WHEN 'Currency' THEN 'OBJECT' WHEN 'Link' THEN 'RELATION' ELSE 'VARCHAR' END AS data_type,
  CASE WHEN native_type = 'Currency' THEN 'FHIR complex type Money' WHEN native_type = 'Link' THEN 'references Any, ' || options
   WHEN native_type = 'Select' AND reqd THEN 'Bound to value set ''' || replace(options, '|', '-') || ''' (required).' END AS note
 FROM line_fields WHERE fieldname IS NOT NULL AND line_no % 2 = 1)"""),
    "reference_targets": build(["doc_types"], f"""
SELECT doc_id, CASE WHEN codes = '' THEN 'OBJECT' WHEN list_contains(cs, 'Reference') THEN 'RELATION'
  ELSE coalesce({PRIMITIVE}, CASE WHEN regexp_matches(c, '^[A-Z]') THEN 'OBJECT' ELSE 'VARCHAR' END) END AS data_type,
 CASE WHEN codes = '' THEN NULL WHEN list_contains(cs, 'Reference') THEN coalesce('references ' || array_to_string({TARGETS}, ', '), 'reference')
  WHEN {PRIMITIVE} IS NULL AND regexp_matches(c, '^[A-Z]') THEN 'FHIR complex type ' || c END AS note
FROM (SELECT *, {CODES} AS cs, {CODES}[1] AS c FROM doc_types)"""),
    "valueset_binding": build(["doc_types"], """
SELECT doc_id, CASE WHEN strength IN ('required', 'extensible') THEN 'Bound to value set ''' ||
 string_split(split_part(value_set, '|', 1), '/')[-1] || ''' (' || strength || ').' END AS note FROM doc_types"""),
    "range_type_pick": build(["doc_types"], f"""
SELECT doc_id, CASE {' '.join(f"WHEN list_contains({RANGES}, '{k}') THEN '{v}'" for k, v in VOCABULARY.items())} ELSE 'RELATION' END AS data_type,
 CASE WHEN NOT list_has_any({RANGES}, {list(VOCABULARY)!r}) THEN 'references ' || array_to_string({NAMED}, ', ') END AS note FROM doc_types"""),
    "type_map_lookup": build(["raw_items"], f"""
SELECT ord, kind, native_type, coalesce(CASE {' '.join(f"WHEN kind = '{k}' THEN {mapped('native_type', TYPE_MAPS[k])}" for k in set(KINDS.values()))} END,
 {mapped('kind', DEFAULTS)}) AS data_type FROM (
 SELECT ord, kind, CASE WHEN kind IN ('odoo', 'tryton') THEN data_type[1] || lower(data_type[2:]) ELSE lower(data_type) END AS native_type FROM (
  SELECT ord, data_type, {mapped('source_standard', KINDS)} AS kind FROM raw_items))"""),
    "spec_line_parse": build(["spec_ok"], "SELECT ord, code, spec, title FROM spec_ok"),
    "spec_classify": build(["spec_ok"], f"""
SELECT ord, code, {SPEC_TYPE} AS data_type, CASE WHEN regexp_matches(spec, '^\\[?[NXYZ](\\.\\.)?\\d+') THEN
 list_max(list_transform(regexp_extract_all(spec, '\\[?([NXYZ])(\\.\\.)?(\\d+)', 3), lambda d: CAST(d AS INT))) END AS byte_length FROM spec_ok"""),
    "range_categorize": build(["spec_ok"], f"SELECT ord, code, CASE {RULES} ELSE '{DEFAULT_CATEGORY}' END AS category FROM spec_ok"),
    "slug_unique": build(["spec_ok"], f"""
SELECT ord, code, 'gs1.' || slug || CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY ord) > 1 THEN '_' || replace(code, '-', '_') ELSE '' END AS name
FROM (SELECT *, {SLUG} AS slug FROM spec_ok)"""),
    "spec_describe": build(["spec_ok"], f"""
SELECT ord, code, 'GS1 Application Identifier (' || code || ') - ' || title || '. GS1 format: ' || spec || '.' ||
 CASE WHEN {SPEC_TYPE} = 'DECIMAL' AND (code[1:3] BETWEEN '310' AND '369' OR code[1:2] = '39')
  THEN ' The last AI digit indicates the number of implied decimal places.' ELSE '' END AS description FROM spec_ok"""),
    "strip_markup": f"SELECT page_id, {PLAIN('html')} AS text FROM pages",
    "declaration_extract": f"""
SELECT page_id, coalesce({PLAIN("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, {PLAIN("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, url) AS owner,
 CAST(i - 1 AS INT) AS position, targets[i] AS target, coalesce({PLAIN('labels[i]')}, targets[i]) AS label,
 nullif(array_to_string(list_filter(list_transform(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: split_part(p, '=', 1)), lambda c: c <> ''), ','), '') AS options
FROM (SELECT *, unnest(range(1, len(targets) + 1)) AS i FROM (
 SELECT *, regexp_extract_all(html, '{LINK}', 1) AS targets, regexp_extract_all(html, '{LINK}', 2) AS labels FROM pages))""",
    "class_closure": build(["closure"], "SELECT node, ancestor FROM closure"),
    "inherited_properties": build(["closure", "part_props"], """
SELECT DISTINCT c.node, p.prop FROM closure c JOIN part_props p ON p.domain_node = c.ancestor"""),
    "enum_members": build(["closure"], """
SELECT c.node, CASE WHEN count(p.p_name) > 0 THEN '["' || string_agg(p.p_name, '","' ORDER BY p.p_name) || '"]' END AS labels
FROM closure c LEFT JOIN part p ON 1 + p.p_partkey % 50 = c.node WHERE c.ancestor = 2 GROUP BY 1"""),
    "range_enumeration": build(["closure", "doc_types"], f"""
SELECT doc_id, CASE {' '.join(f"WHEN list_contains({RANGES}, '{k}') THEN '{v}'" for k, v in VOCABULARY.items())} WHEN node IS NOT NULL THEN 'VARCHAR' ELSE 'RELATION' END AS data_type,
 CASE WHEN NOT list_has_any({RANGES}, {list(VOCABULARY)!r}) THEN labels END AS allowed_values,
 CASE WHEN NOT list_has_any({RANGES}, {list(VOCABULARY)!r}) THEN CASE WHEN node IS NOT NULL THEN 'enumeration C' || node ELSE 'references ' || array_to_string({NAMED}, ', ') END END AS note
FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN ranges || '|schema:C' || (1 + doc_id % 50) ELSE ranges END AS ranges, CASE WHEN doc_id % 2 = 0 THEN 1 + doc_id % 50 END AS own FROM doc_types)
LEFT JOIN (SELECT c.node, CASE WHEN count(p.p_name) > 0 THEN '["' || string_agg(p.p_name, '","' ORDER BY p.p_name) || '"]' END AS labels
 FROM closure c LEFT JOIN part p ON 1 + p.p_partkey % 50 = c.node WHERE c.ancestor = 2 GROUP BY 1) ON node = own"""),
    "relation_note": build(["raw_items"], """
SELECT ord, nullif(concat_ws(' ', coalesce(nullif(description, ''), title), CASE WHEN ord % 4 = 0 AND ord % 3 > 0 THEN '(references ' || lower(category) || ')'
 WHEN ord % 4 = 1 AND ord % 3 > 0 THEN '(collection of ' || lower(category) || ')' WHEN ord % 4 = 2 THEN '(repeatable / collection)' END), '') AS description
FROM raw_items"""),
    "per_entity_counts": build(["raw_items"], f"""
SELECT 'category' AS grain, category AS value, count(*) AS items FROM raw_items GROUP BY 2
UNION ALL SELECT 'document', source_url, count(*) FROM raw_items GROUP BY 2
UNION ALL SELECT 'entity', {RAW_ENTITY}, count(*) FROM raw_items GROUP BY 2"""),
    "source_file_route": build(["raw_items"], f"""
SELECT ord, e AS entity, 'https://example.org/schema/' || {ROUTE} || '.xsd' AS source_url FROM (SELECT ord, {RAW_ENTITY} AS e FROM raw_items)"""),
    "write_catalog": build(["clean"], f"SELECT {CATALOG} FROM clean"),
    "export_csv": build(["clean"], """
SELECT name, title, data_type, byte_length, is_required, allowed_values, source_standard FROM clean WHERE category = 'MACHINERY'"""),
    "export_entity_json": build(["clean"], r"""
SELECT CASE WHEN row_number() OVER (ORDER BY name, category) = 1 THEN '[' ELSE ',' END || body ||
 CASE WHEN row_number() OVER (ORDER BY name DESC, category DESC) = 1 THEN ']' ELSE '' END AS value FROM (
 SELECT name, category, CAST(json_object('name', name, 'type', data_type, 'required', is_required, 'description', description) AS VARCHAR) AS body
 FROM clean WHERE name LIKE 'invoice.%')"""),
}
# Lines out of files: those of three of four folders, numbered in the order of the folders.
FILED = "(SELECT row_number() OVER (ORDER BY ord % 4, ord) AS line_no, ord FROM spec_lines WHERE ord % 4 < 3)"
ORACLES["spec_file_items"] = build(["spec_ok"], f"""
SELECT line_no AS ord, code, spec, 'gs1.' || slug || CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY line_no) > 1 THEN '_' || replace(code, '-', '_') ELSE '' END AS name
FROM (SELECT l.line_no, s.code, s.spec, {SLUG} AS slug FROM spec_ok s JOIN {FILED} l USING (ord))""")
ORACLES["rejected_files"] = build(["spec_lines"], "SELECT 3 AS folder, 'not UTF-8' AS reason, count(*) AS lines, CAST(1 AS BIGINT) AS first_bad FROM spec_lines WHERE ord % 4 = 3 HAVING count(*) > 0")
ORACLES["range_join"] = ORACLES["range_categorize"]
ORACLES["range_join_orders"] = """
SELECT o.o_orderkey, min(r.c) AS first, count(*) AS ranges FROM orders o JOIN (
 SELECT o_custkey AS c, min(o_orderkey) AS lo, least(max(o_orderkey), min(o_orderkey) + 2000) AS hi FROM orders GROUP BY 1) r
ON o.o_orderkey BETWEEN r.lo AND r.hi GROUP BY 1"""
ORACLES["inherited_by_interval"] = ORACLES["inherited_properties"]
define("odd_tree", ["part_tree"], """
SELECT node, parent FROM part_tree UNION SELECT node, node // 3 + 1 FROM part_tree WHERE node % 97 = 5
UNION SELECT * FROM (VALUES (2, 9), (-1, -2), (-2, -3), (-3, -1), (-4, -2)) AS v(node, parent)""")
define("odd_closure", ["odd_tree"], """
SELECT node, node AS ancestor FROM odd_tree UNION
SELECT c.node, t.parent AS ancestor FROM odd_closure c JOIN odd_tree t ON t.node = c.ancestor WHERE t.parent IN (SELECT node FROM odd_tree)""")
ORACLES["inherited_irregular"] = build(["odd_closure", "part_props"], """
SELECT DISTINCT c.node, p.prop FROM odd_closure c JOIN (SELECT prop, domain_node FROM part_props UNION SELECT 'ring', -3) p ON p.domain_node = c.ancestor""")
# The vocabulary that the graph documents describe, from the tables they are made of; class 2 has the enumeration class above it too.
define("voc_enum", ["closure"], "SELECT DISTINCT node FROM closure WHERE ancestor = 2")
define("voc_labels", ["voc_enum"], """
SELECT e.node, CASE WHEN count(p.p_name) > 0 THEN '["' || string_agg(p.p_name, '","' ORDER BY p.p_name) || '"]' END AS labels
FROM voc_enum e LEFT JOIN part p ON 1 + p.p_partkey % 50 = e.node GROUP BY 1""")
define("voc_props", ["part_props", "voc_labels"], """
SELECT p.prop, n, CASE WHEN n % 5 = 0 THEN replace(prop, '#', '') ELSE lower(prop) END AS label, CASE WHEN n % 4 > 0 THEN 'Brand no ' || n END AS comment,
 CASE n % 5 WHEN 0 THEN 'VARCHAR' WHEN 1 THEN CASE WHEN e4.node IS NULL THEN 'RELATION' ELSE 'VARCHAR' END WHEN 2 THEN CASE WHEN e3.node IS NULL THEN 'RELATION' ELSE 'VARCHAR' END
  WHEN 3 THEN 'DATETIME' ELSE 'RELATION' END AS data_type,
 CASE n % 5 WHEN 1 THEN e4.labels WHEN 2 THEN e3.labels END AS allowed_values,
 CASE n % 5 WHEN 1 THEN CASE WHEN e4.node IS NULL THEN '(references Person, C4)' ELSE '(enumeration C4)' END
  WHEN 2 THEN CASE WHEN e3.node IS NULL THEN '(references C3)' ELSE '(enumeration C3)' END END AS note
FROM (SELECT DISTINCT prop, CAST(substr(prop, 7) AS BIGINT) AS n FROM part_props) p
LEFT JOIN voc_labels e4 ON e4.node = 4 LEFT JOIN voc_labels e3 ON e3.node = 3""")
ORACLES["vocabulary_items"] = build(["closure", "part_props", "voc_props"], """
SELECT DISTINCT 'Group ' || (c.node % 4) AS category, 'C' || c.node || '.' || v.label AS name, v.label AS title, nullif(concat_ws(' ', v.comment, v.note), '') AS description,
 v.data_type, v.allowed_values, 'https://schema.org/' || v.label AS source_url
FROM closure c JOIN part_props p ON p.domain_node = c.ancestor JOIN voc_props v USING (prop) WHERE c.node % 9 = 1""")
# Declarations of the program texts, from the parts that they are made of; texts that start with a closing bracket are not read. Positions count other declarations too.
READ = "p_partkey // 5 % 11 <> 5"
ORACLES["declared_fields"] = f"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INT) AS position, name, kind, data_type, title, target, is_required, allowed_values FROM (
 SELECT p_partkey // 5 AS doc_id, p_partkey AS k, 'f' || p_partkey AS name, ['Selection', 'Many2one', 'Float', 'Char', 'Text'][p_partkey % 5 + 1] AS kind,
  ['VARCHAR', 'RELATION', 'DECIMAL', 'VARCHAR', 'TEXT'][p_partkey % 5 + 1] AS data_type,
  CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 3 THEN p_type ELSE 'f' || p_partkey END AS title,
  CASE WHEN p_partkey % 5 = 1 THEN 'res.' || lower(p_type) END AS target, p_partkey % 5 = 0 AS is_required,
  CASE WHEN p_partkey % 5 = 0 THEN '["a' || p_size || '","b]","c,("]' END AS allowed_values FROM part WHERE {READ})"""
ORACLES["declared_options"] = f"""
SELECT p_partkey // 5 AS doc_id, 'f' || p_partkey AS name, CAST(o AS INT) AS option, CASE o WHEN 0 THEN 'a' || p_size WHEN 1 THEN 'b]' ELSE 'c,(' END AS code,
 CASE o WHEN 0 THEN p_brand || ' (x)' WHEN 1 THEN 'It''s' ELSE 'c,(' END AS label FROM part, (SELECT unnest([0, 1, 2]) AS o) WHERE p_partkey % 5 = 0 AND {READ}"""
# From documents to the catalog: the extraction oracles, united, and the merge over them.
def inner(key: str) -> str:
    """The last SELECT of an oracle, without the tables before it."""
    needs = {"json_field_list": ["line_fields"], "json_path_elements": ["line_fields"], "json_schema_props": ["props"], "spec_describe": ["spec_ok"], "spec_classify": ["spec_ok"], "slug_unique": ["spec_ok"], "range_categorize": ["spec_ok"]}[key]
    return ORACLES[key].removeprefix(build(needs, "")).replace("FROM line_fields", "FROM x_lines")


NO_TEXT, NO_NUMBER = "CAST(NULL AS VARCHAR)", "CAST(NULL AS INT)"
AREA, PLACE = "'Area ' || (doc_id % 40 % 5)", "'https://example.org/schema/' || doc_id"
define("x_lines", [], view_sql("lines"))
define("x_attrs", ["x_lines"], CTES["attrs"][1].replace("FROM line_fields", "FROM x_lines"))
define("x_raw_items", ["x_attrs", "x_lines", "props", "spec_ok"], f"""
SELECT (0::BIGINT << 44) + (doc_id * 1024 + line_no) * 2 + CASE WHEN attribute = 'rowVersion' THEN 1 ELSE 0 END AS ord, {AREA} AS category, entity || '.' || attribute AS name, title, description, data_type,
 byte_length, is_required, {NO_TEXT} AS allowed_values, 'cdm' AS source_standard, {PLACE} AS source_url FROM x_attrs
UNION ALL SELECT (1::BIGINT << 44) + doc_id * 1024 + line_no, {AREA}, name, title, description, data_type, {NO_NUMBER}, is_required, {NO_TEXT}, 'fhir', {PLACE} FROM ({inner("json_path_elements")})
UNION ALL SELECT (2::BIGINT << 44) + doc_id * 1024 + line_no, {AREA}, name, title, description, data_type, byte_length, is_required, allowed_values, 'frappe', {PLACE} FROM ({inner("json_field_list")})
UNION ALL SELECT (3::BIGINT << 44) + ord, category, name, title, description, data_type, byte_length, false, {NO_TEXT}, 'gs1', {NO_TEXT} FROM ({inner("slug_unique")}) JOIN (SELECT ord, title FROM spec_ok) USING (ord)
 JOIN ({inner("spec_describe")}) USING (ord) JOIN ({inner("spec_classify")}) USING (ord) JOIN ({inner("range_categorize")}) USING (ord)
UNION ALL SELECT (4::BIGINT << 44) + event_id, 'Events', name, title, description, data_type, byte_length, is_required, allowed_values, 'openapi', {NO_TEXT} FROM ({inner("json_schema_props")})""")
define("x_items", ["x_raw_items"], f"SELECT *, {NO_NUMBER} AS decimal_scale, {NO_TEXT} AS format_mask, {NO_TEXT} AS version FROM x_raw_items")
define("x_resolved", ["x_items"], CTES["resolved"][1].replace("raw_items", "x_items").replace("account.invoice' THEN 'invoice'", "order1' THEN 'order0'").replace(" WHEN 'sale.sale' THEN 'order'", "")
       .replace(lookup("base_name", FIELD_ALIASES, "NULL"), NO_TEXT))
define("x_norm", ["x_resolved"], CTES["norm"][1].replace("FROM resolved", "FROM x_resolved"))
merged("x_clean", "x_norm", "category, name")
ORACLES["extracted_catalog"] = build(["x_clean"], """
SELECT category, name, title, description, data_type, byte_length, is_required, allowed_values, source_standard, n_members, n_sources FROM x_clean""")
ORACLES["rejected_documents"] = build(["line_fields"], """
SELECT doc_id, line_no, CASE doc_id % 13 WHEN 1 THEN 'not JSON' WHEN 3 THEN 'missing' ELSE 'no definitions' END AS reason FROM line_fields WHERE doc_id % 13 BETWEEN 1 AND 4""")
ORACLES["structure_note"] = build(["raw_items"], """
SELECT ord, CASE ord % 8 WHEN 0 THEN 'VARCHAR' WHEN 1 THEN 'VARCHAR' WHEN 2 THEN 'DATETIME' WHEN 7 THEN NULL ELSE 'OBJECT' END AS data_type,
 nullif(concat_ws(' ', nullif(trim(title), ''), CASE ord % 8 WHEN 3 THEN 'Composite value (ValueString + DataType + UnitOfMeasure).' WHEN 4 THEN 'Composite quantity (QuantityString + DataType + UnitOfMeasure).'
  WHEN 5 THEN 'Nested ISA-95 structure (StatusType).' WHEN 6 THEN 'Nested ISA-95 structure (ResourceLocationType).' END, CASE WHEN ord % 3 = 0 THEN '(repeatable / collection)' END), '') AS description FROM raw_items""")
