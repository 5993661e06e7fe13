"""Common table expressions shared by the oracles, in DuckDB's dialect."""

from __future__ import annotations

from fieldloom.sources.tables import ENTITY_ALIASES, FIELD_ALIASES, view_sql


def snake(x: str) -> str:
    """One token in snake case."""
    x = f"regexp_replace(trim({x}), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
    x = f"regexp_replace({x}, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')"
    x = f"replace(replace({x}, ' ', '_'), '-', '_')"
    return f"trim(lower(regexp_replace({x}, '_+', '_', 'g')), '_')"


def snake_all(x: str) -> str:
    """Every dotted segment in snake case."""
    return f"array_to_string(list_transform(string_split({x}, '.'), lambda s: {snake('s')}), '.')"


def entity(x: str) -> str:
    return f"array_to_string(string_split({x}, '.')[:-2], '.')"


def field(x: str) -> str:
    return f"string_split({x}, '.')[-1]"


def whole_entity(x: str) -> str:
    return f"CASE WHEN contains({x}, '.') THEN {entity(x)} ELSE {x} END"


def identifier(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^0-9a-z]+', '_', 'g'), '_')"


def lookup(x: str, pairs: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {x} {whens} ELSE {default} END"


CTES: dict[str, tuple[list[str], str]] = {}


def define(name: str, needs: list[str], body: str) -> None:
    CTES[name] = (needs, body)


for _view in ("raw_items", "line_fields", "event_props", "spec_lines", "part_tree", "part_props", "doc_types", "curated",
              "category_names", "terms", "aliases"):
    define(_view, [], view_sql(_view))

define("categories", ["category_names"],
       "SELECT CAST(row_number() OVER (ORDER BY name) AS INT) AS category_id, name FROM category_names")

define("resolved", ["raw_items"], f"""
SELECT *, {lookup('base_name', FIELD_ALIASES, 'NULL')} AS canonical_field FROM (
 SELECT *, CASE WHEN canonical_entity IS NULL THEN dotted ELSE canonical_entity || '.' || {field('dotted')} END AS base_name FROM (
  SELECT *, {lookup('source_entity', ENTITY_ALIASES, 'NULL')} AS canonical_entity FROM (
   SELECT *, CASE WHEN contains(dotted, '.') THEN {entity('dotted')} END AS source_entity FROM (
    SELECT *, {snake_all('name')} AS dotted FROM raw_items))))
""")

define("norm", ["resolved"], """
SELECT * REPLACE (coalesce(canonical_field, base_name) AS name),
 CASE WHEN description <> '' THEN 3 ELSE 0 END + CASE WHEN title <> '' THEN 1 ELSE 0 END
 + CASE WHEN data_type <> '' AND data_type <> 'RELATION' THEN 1 ELSE 0 END
 + CASE WHEN byte_length IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN allowed_values <> '' THEN 2 ELSE 0 END AS score
FROM resolved
""")


def merged(prefix: str, source: str, key: str) -> None:
    """CTEs that merge the rows of ``source`` by ``key``."""
    by_source = "source_standard" in key
    using = "USING (" + key + ")"
    match = " AND ".join(f"a.{k.strip()} IS NOT DISTINCT FROM b.{k.strip()}" for k in key.split(","))

    def joined(name: str, col: str, sep: str) -> None:
        define(f"{prefix}_{name}", [source], f"""
SELECT {key}, string_agg(v, '{sep}' ORDER BY o) AS {name} FROM (
 SELECT {key}, {col} AS v, min(ord) AS o FROM {source} WHERE {col} <> '' GROUP BY {key}, {col}) GROUP BY {key}""")

    if not by_source:
        joined("sources", "source_standard", "; ")
    joined("urls", "source_url", " | ")
    joined("versions", "version", "; ")
    define(f"{prefix}_vals", [source], f"""
SELECT {key}, owner, v, min(o) AS o FROM (
 SELECT {key}, coalesce(nullif(source_standard, ''), 'unknown') AS owner, CAST(vs[i] AS VARCHAR) AS v, ord * 1000 + i AS o FROM (
  SELECT {key}{'' if by_source else ', source_standard'}, ord, vs, unnest(range(1, len(vs) + 1)) AS i FROM (
   SELECT *, json_extract(CAST(allowed_values AS JSON), '$[*]') AS vs FROM {source} WHERE allowed_values <> '')))
GROUP BY {key}, owner, v""")
    define(f"{prefix}_lists", [f"{prefix}_vals"], f"""
SELECT {key}, owner, list(v ORDER BY o) AS vs, min(o) AS o FROM {prefix}_vals GROUP BY {key}, owner""")
    define(f"{prefix}_flat", [f"{prefix}_vals", f"{prefix}_lists"], f"""
SELECT {key}, string_agg(v, ',' ORDER BY so, o) AS flat FROM (
 SELECT {', '.join('a.' + k.strip() for k in key.split(','))}, a.v, a.o, b.o AS so,
  row_number() OVER (PARTITION BY {', '.join('a.' + k.strip() for k in key.split(','))}, a.v ORDER BY b.o, a.o) AS rn
 FROM {prefix}_vals a JOIN {prefix}_lists b ON {match} AND a.owner = b.owner) WHERE rn = 1 GROUP BY {key}""")
    define(f"{prefix}_values", [f"{prefix}_lists", f"{prefix}_flat"], f"""
SELECT {', '.join('a.' + k.strip() for k in key.split(','))}, CASE WHEN n = 1 THEN '[' || flat || ']' ELSE obj END AS merged_values FROM (
 SELECT {key}, count(DISTINCT list_sort(vs)) AS n,
  '{{' || string_agg('"' || owner || '":[' || array_to_string(vs, ',') || ']', ',' ORDER BY owner) || '}}' AS obj
 FROM {prefix}_lists GROUP BY {key}) a JOIN {prefix}_flat b ON {match}""")
    define(f"{prefix}_core", [source], f"""
SELECT {key}, count(*) AS n_members, min(ord) AS first_ord,
 count(DISTINCT source_standard) + max(CASE WHEN source_standard IS NULL THEN 1 ELSE 0 END) AS n_sources,
 first(title ORDER BY score DESC, ord) AS p_title, first(data_type ORDER BY score DESC, ord) AS data_type,
 first(decimal_scale ORDER BY score DESC, ord) AS decimal_scale, first(format_mask ORDER BY score DESC, ord) AS format_mask,
 first(description ORDER BY length(coalesce(description, '')) DESC, ord) AS description,
 first(title ORDER BY CASE WHEN title <> '' THEN 0 ELSE 1 END, ord) AS f_title,
 max(byte_length) AS byte_length, bool_or(is_required) AS is_required,
 first(allowed_values ORDER BY ord) AS f_values
FROM {source} GROUP BY {key}""")
    parts = ["urls", "versions", "values"] + ([] if by_source else ["sources"])
    joins = " ".join(
        f"LEFT JOIN {prefix}_{p} {p} ON " + match.replace("b.", f"{p}.") for p in parts)
    source_col = "a.source_standard" if by_source else "sources.sources AS source_standard"
    define(prefix, [f"{prefix}_core"] + [f"{prefix}_{p}" for p in parts], f"""
SELECT a.category, a.name, coalesce(nullif(a.p_title, ''), a.f_title) AS title, a.description, a.data_type, a.byte_length,
 a.decimal_scale, a.is_required, CASE WHEN n_members = 1 THEN true ELSE NOT a.is_required END AS is_nullable,
 CAST(NULL AS VARCHAR) AS default_value,
 CASE WHEN n_members = 1 THEN a.f_values ELSE values.merged_values END AS allowed_values, a.format_mask,
 {source_col}, urls.urls AS source_url, versions.versions AS version, a.first_ord, a.n_members,
 CAST(a.n_sources AS BIGINT) AS n_sources
FROM {prefix}_core a {joins}""")


merged("clean", "norm", "category, name")


def build(needs: list[str], select: str) -> str:
    """``WITH`` the needed CTEs in dependency order, then the query."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for n in CTES[name][0]:
            visit(n)
        order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return select.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH RECURSIVE {ctes}\n{select.strip()}"
