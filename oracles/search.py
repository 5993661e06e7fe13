"""Oracles for search, table definitions and upserts."""

import re

from fieldloom.operators.upsert import ITEM_COLUMNS

from .base import CTES, build, define, identifier, merged, whole_entity
from .rules import COLLECTION, ENT, REST, TARGET, TEXTS, check_text, dialect

define("items", ["clean"], f"SELECT *, lower({ENT}) AS ent FROM clean")
define("h_cat", ["items", "terms"], """
SELECT t.term_pos, t.term, i.category, i.name FROM terms t JOIN items i ON lower(i.category) LIKE '%' || lower(t.term) || '%'""")


def is_entity(term: str) -> str:
    return f"(i.ent = lower({term}) OR starts_with(i.ent, lower({term}) || '_') OR starts_with(i.ent, lower({term}) || '.'))"


define("h_ent", ["items", "terms"], f"SELECT t.term_pos, t.term, i.category, i.name FROM terms t JOIN items i ON {is_entity('t.term')}")
define("h_key", ["items", "terms"], """
SELECT t.term_pos, t.term, i.category, i.name FROM terms t JOIN items i ON lower(i.name) LIKE '%' || lower(t.term) || '%'
 OR lower(coalesce(i.title, '')) LIKE '%' || lower(t.term) || '%' OR lower(coalesce(i.description, '')) LIKE '%' || lower(t.term) || '%'""")
define("a_ent", ["items", "terms", "aliases"], f"""
SELECT t.term_pos, t.term, a.target_pos, a.target, i.category, i.name FROM terms t JOIN aliases a ON a.term = lower(t.term)
JOIN items i ON {is_entity('a.target')}""")
define("a_all", ["a_ent", "items", "terms", "aliases"], """
SELECT * FROM a_ent UNION ALL SELECT t.term_pos, t.term, a.target_pos, a.target, i.category, i.name
FROM terms t JOIN aliases a ON a.term = lower(t.term) JOIN items i ON lower(i.category) LIKE '%' || lower(a.target) || '%'
WHERE NOT EXISTS (SELECT 1 FROM a_ent x WHERE x.term_pos = t.term_pos AND x.target_pos = a.target_pos)""")
define("h_alias", ["a_all"], """
SELECT term_pos, term, name, first(category ORDER BY target_pos, category) AS category FROM a_all GROUP BY 1, 2, 3""")
define("a_targets", ["a_all"], """
SELECT term, string_agg(target, ', ' ORDER BY target_pos) AS targets FROM (SELECT DISTINCT term, target_pos, target FROM a_all) GROUP BY 1""")
define("hits", ["h_cat", "h_ent", "h_alias", "h_key"], """
SELECT level, term_pos, term, category, name FROM (SELECT *, min(lv) OVER (PARTITION BY term_pos) AS best FROM (
 SELECT 1 AS lv, 'category' AS level, term_pos, term, category, name FROM h_cat
 UNION ALL SELECT 2, 'entity', term_pos, term, category, name FROM h_ent
 UNION ALL SELECT 3, 'alias', term_pos, term, category, name FROM h_alias
 UNION ALL SELECT 4, 'keyword', term_pos, term, category, name FROM h_key)) WHERE lv = best""")

DDL_COLS = "data_type, byte_length, decimal_scale, is_required, allowed_values, description"
define("picked", ["clean"], "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY category) AS rn FROM clean) WHERE rn = 1")
define("cand", ["picked"], f"""
SELECT *, {COLLECTION} AS is_coll, {TARGET} AS target FROM (
 SELECT {identifier(ENT)} AS table_name, {identifier(REST)} AS column_name, name, {DDL_COLS} FROM picked)
WHERE column_name <> '' AND column_name <> table_name || '_id'""")
define("tabs", ["picked"], f"SELECT DISTINCT {identifier(ENT)} AS table_name FROM picked")
define("firsts", ["cand"], """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, column_name ORDER BY is_required DESC, name) AS rn
 FROM cand WHERE NOT is_coll) WHERE rn = 1""")
define("cols", ["firsts", "tabs"], """
SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY is_required DESC, name) AS position,
 coalesce(target IN (SELECT table_name FROM tabs), false) AS is_fk FROM firsts""")
define("revs", ["cand", "firsts"], """
SELECT c.* FROM cand c LEFT JOIN firsts f USING (table_name, column_name) WHERE c.is_coll AND (f.name IS NULL
 OR (c.is_required AND NOT f.is_required) OR (c.is_required = f.is_required AND c.name < f.name))""")
define("deps", ["cols"], "SELECT DISTINCT table_name AS child, target AS parent FROM cols WHERE is_fk AND target <> table_name")
# Longest path from a table to one without parents; tables on or behind a cycle never finish.
define("paths", ["tabs", "deps"], """
SELECT table_name, 0 AS depth FROM tabs UNION SELECT d.child, p.depth + 1 FROM paths p JOIN deps d ON d.parent = p.table_name
WHERE p.depth < (SELECT count(*) FROM tabs)""")
define("levels", ["paths", "tabs"], """
SELECT table_name, CASE WHEN depth >= n THEN 1 + coalesce(max(CASE WHEN depth < n THEN depth END) OVER (), -1) ELSE depth END AS level
FROM (SELECT table_name, max(depth) AS depth, (SELECT count(*) FROM tabs) AS n FROM paths GROUP BY 1)""")
define("about", ["picked"], f"""
SELECT {identifier(ENT)} AS table_name, first(source_standard ORDER BY name) AS source, first(e ORDER BY name DESC) AS entity
FROM (SELECT *, {ENT} AS e FROM picked) GROUP BY 1""")
define("sizes", ["about", "cols"], """
SELECT a.*, count(c.name) AS n_columns, count(*) FILTER (c.is_fk) AS n_keys, max(c.position) AS last_column,
 max(CASE WHEN c.is_fk THEN c.position END) AS last_key FROM about a LEFT JOIN cols c USING (table_name) GROUP BY ALL""")
PK = {"sqlite": "INTEGER PRIMARY KEY", "postgres": "SERIAL PRIMARY KEY", "mysql": "INT AUTO_INCREMENT PRIMARY KEY"}


def script(i: int, d: str) -> str:
    kind = dialect(i).replace(f"({TARGET}) IS NOT NULL", "is_fk")
    return f"""
SELECT '{d}' AS dialect, level, table_name, section, position, line FROM (
 SELECT table_name, 0 AS section, 0 AS position, '-- ' || entity || '  (' || n_columns || ' columns, ' || n_keys || ' FKs)  [source: ' || coalesce(source, 'None') || ']' AS line FROM sizes
 UNION ALL SELECT table_name, 1, row_number() OVER (PARTITION BY table_name ORDER BY is_required DESC, name), '--   reverse relation: ' || column_name || '  ' || description FROM revs
 UNION ALL SELECT table_name, 2, 0, 'CREATE TABLE ' || table_name || ' (' FROM sizes
 UNION ALL SELECT table_name, 3, 0, '    ' || table_name || '_id {PK[d]}' || CASE WHEN n_columns > 0 THEN ',' ELSE '' END FROM sizes
 UNION ALL SELECT table_name, 4, position, '    ' || column_name || ' ' || {kind} || CASE WHEN is_required THEN ' NOT NULL' ELSE '' END
  || CASE WHEN NOT is_fk THEN coalesce(' ' || {check_text('column_name')}, '') ELSE '' END
  || CASE WHEN n_keys > 0 OR position < last_column THEN ',' ELSE '' END
  || CASE WHEN target IS NOT NULL AND NOT is_fk THEN '  -- external ref: ' || description[1:50] ELSE '' END
  FROM (SELECT c.*, {TEXTS} AS texts, s.n_keys, s.last_column FROM cols c JOIN sizes s USING (table_name))
 UNION ALL SELECT table_name, 5, position, '    FOREIGN KEY (' || column_name || ') REFERENCES ' || target || '(' || target || '_id)'
  || CASE WHEN position < last_key THEN ',' ELSE '' END FROM cols JOIN sizes USING (table_name) WHERE is_fk
 UNION ALL SELECT table_name, 6, 0, ');' FROM sizes) JOIN levels USING (table_name)"""


PLAIN = lambda x: f"regexp_replace(lower({x}), '[^0-9a-z_]', '_', 'g')"
PLAIN_TYPE = """CASE data_type WHEN 'VARCHAR' THEN 'VARCHAR(' || CASE WHEN byte_length <> 0 THEN byte_length ELSE 255 END || ')'
 WHEN 'INTEGER' THEN 'INTEGER' WHEN 'DECIMAL' THEN 'DECIMAL(18,' || coalesce(decimal_scale, 2) || ')' WHEN 'BOOLEAN' THEN 'BOOLEAN'
 WHEN 'DATE' THEN 'DATE' WHEN 'DATETIME' THEN 'DATETIME' WHEN 'TIME' THEN 'TIME' WHEN 'RELATION' THEN 'INTEGER' ELSE 'TEXT' END"""
define("plain", ["picked"], f"""
SELECT *, row_number() OVER (PARTITION BY entity ORDER BY is_required DESC, name) AS position, count(*) OVER (PARTITION BY entity) AS n
FROM (SELECT *, {ENT} AS entity, {PLAIN(REST)} AS column_name, {TEXTS} AS texts FROM picked)""")

KEY3 = "category, name, source_standard"
define("norm_base", ["norm"], "SELECT * FROM norm WHERE ord % 3 > 0 OR ord % 2 = 0")
define("norm_delta", ["norm"], "SELECT * FROM norm WHERE ord % 3 = 0")
merged("ubase", "norm_base", KEY3)
merged("udelta", "norm_delta", KEY3)
for _i in range(4):
    define(f"norm_b{_i}", ["norm"], f"SELECT * FROM norm WHERE ord % 4 = {_i}")
    merged(f"ub{_i}", f"norm_b{_i}", KEY3)
UPSERT = ", ".join(f"coalesce(d.{c}, b.{c}) AS {c}" for c in ITEM_COLUMNS)
LATEST = ", ".join(f"first({c} ORDER BY seq DESC) FILTER ({c} IS NOT NULL) AS {c}" for c in ITEM_COLUMNS)

COLS_OUT = "table_name, position, column_name, name, data_type, byte_length, decimal_scale, is_required, is_fk, target"
ORACLES = {
    "term_match_theta": build(["h_cat", "h_ent", "h_key"], """
SELECT term_pos, category, name, 'category' AS kind FROM h_cat UNION ALL SELECT term_pos, category, name, 'entity' FROM h_ent
UNION ALL SELECT term_pos, category, name, 'text' FROM h_key"""),
    "search_category": build(["h_cat"], "SELECT * FROM h_cat"),
    "search_entity": build(["h_ent"], "SELECT * FROM h_ent"),
    "search_alias": build(["h_alias", "a_targets"], "SELECT h.*, a.targets FROM h_alias h JOIN a_targets a USING (term)"),
    "search_keyword": build(["h_key"], "SELECT * FROM h_key"),
    "resolve_terms": build(["hits"], "SELECT * FROM hits"),
    "search_summary": build(["hits", "terms"], f"""
SELECT t.term_pos, t.term, coalesce(max(level), 'keyword') AS level, count(name) AS items, count(DISTINCT {whole_entity('name')}) AS entities,
 count(DISTINCT category) AS categories FROM terms t LEFT JOIN hits h USING (term_pos) GROUP BY 1, 2"""),
    "search_topn": build(["hits"], """
SELECT level, term_pos, term, category, name, CAST(rn AS INT) AS rank, greatest(total - 12, 0) AS more FROM (
 SELECT *, row_number() OVER (PARTITION BY term_pos ORDER BY name, category) AS rn, count(*) OVER (PARTITION BY term_pos) AS total FROM hits)
WHERE rn <= 12"""),
    "search_union": build(["hits"], """
SELECT level, term_pos, term, category, name FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY term_pos, category) AS rn FROM hits) WHERE rn = 1"""),
    "entity_table_defs": build(["cols"], f"SELECT {COLS_OUT} FROM cols"),
    "fk_edges": build(["cols"], "SELECT table_name AS child, column_name, target AS parent FROM cols WHERE is_fk"),
    "fk_edge_join": build(["cols"], """
SELECT table_name AS child, target AS parent, count(*) AS columns,
 CASE WHEN NOT bool_and(is_fk) THEN 'external' WHEN table_name = target THEN 'self' ELSE 'foreign_key' END AS kind
FROM cols WHERE target IS NOT NULL GROUP BY 1, 2"""),
    "reverse_relations": build(["revs"], "SELECT table_name, column_name, name, description FROM revs"),
    "external_refs": build(["cols"], "SELECT table_name, column_name, target FROM cols WHERE target IS NOT NULL AND NOT is_fk"),
    "dependency_levels": build(["levels"], "SELECT table_name, level FROM levels"),
    "create_table_text": build(["sizes", "cols", "revs", "levels"], " UNION ALL ".join(
        script(i, d) for i, d in enumerate(("sqlite", "postgres", "mysql")))),
    "create_table_plain": build(["plain"], f"""
SELECT entity, 0 AS section, 0 AS position, '-- ' || entity || ' (' || count(*) || ' fields)' AS line FROM plain GROUP BY 1
UNION ALL SELECT DISTINCT entity, 2, 0, 'CREATE TABLE ' || {PLAIN('entity')} || ' (' FROM plain
UNION ALL SELECT DISTINCT entity, 3, 0, '    ' || {PLAIN('entity')} || '_id INTEGER PRIMARY KEY,' FROM plain
UNION ALL SELECT entity, 4, position, '    ' || column_name || ' ' || {PLAIN_TYPE} || CASE WHEN is_required THEN ' NOT NULL' ELSE '' END
 || coalesce(' ' || {check_text('column_name')}, '') || CASE WHEN position < n THEN ',' ELSE '' END FROM plain
UNION ALL SELECT DISTINCT entity, 6, 0, ');' FROM plain"""),
    "upsert_items": build(["ubase", "udelta"], f"""
SELECT coalesce(d.category, b.category) AS category, coalesce(d.name, b.name) AS name,
 coalesce(d.source_standard, b.source_standard) AS source_standard, {UPSERT}
FROM ubase b FULL JOIN udelta d ON b.category = d.category AND b.name = d.name AND b.source_standard IS NOT DISTINCT FROM d.source_standard"""),
    "upsert_stream": build([f"ub{i}" for i in range(4)], f"SELECT {KEY3}, {LATEST} FROM (" + " UNION ALL ".join(
        f"SELECT *, {i} AS seq FROM ub{i}" for i in range(4)) + f") GROUP BY {KEY3}"),
}
# The same rows out of the versioned store.
ORACLES["upsert_stream_compacted"] = ORACLES["upsert_stream"]
ORACLES["upsert_stored"] = ORACLES["upsert_items"]

# Scripts of what two terms resolve to: the same tables over another selection.
CHAIN = ["cand", "tabs", "firsts", "cols", "revs", "deps", "paths", "levels", "about", "sizes"]
NAMES = re.compile(r"\b(" + "|".join(["picked", *CHAIN]) + r")\b")
define("s_picked", ["hits", "clean"], """
SELECT c.* FROM clean c JOIN (SELECT name, first(category ORDER BY term_pos, category) AS category FROM hits WHERE term IN ('invoice', 'urgent') GROUP BY 1) h USING (category, name)""")
for _name in CHAIN:
    define(f"s_{_name}", [NAMES.sub(r"s_\1", n) for n in CTES[_name][0]], NAMES.sub(r"s_\1", CTES[_name][1]))
HEAD = " UNION ALL ".join(f"SELECT '{d}' AS dialect, -1 AS level, '' AS table_name, 0 AS section, {n} AS position, {line} AS line" for d, first in (
    ("sqlite", "PRAGMA foreign_keys = ON;"), ("postgres", None), ("mysql", "SET FOREIGN_KEY_CHECKS = 1;")) for n, line in enumerate((
        f"'-- dialect: {d}'", "'-- terms: invoice, urgent'", "'-- ' || (SELECT count(*) FROM s_tabs) || ' tables, ' || (SELECT count(*) FROM s_picked) || ' items'",
        first and f"'{first}'")) if line)
ORACLES["create_table_selected"] = build(["s_sizes", "s_cols", "s_revs", "s_levels", "s_tabs"], HEAD + " UNION ALL " + " UNION ALL ".join(
    NAMES.sub(r"s_\1", script(i, d)) for i, d in enumerate(("sqlite", "postgres", "mysql"))))
ORACLES["external_refs_selected"] = build(["s_cols"], "SELECT table_name, column_name, target FROM s_cols WHERE target IS NOT NULL AND NOT is_fk")
