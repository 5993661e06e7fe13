"""Input tables and the views derived from them.

The views are plain SQL over the given Parquet tables.  Table names appear as
``$name`` so that the same text can be bound to Parquet paths here and to plain
table names in the SQL oracles.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..storage import materialize

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

RAW_ITEMS = """
SELECT o_orderkey AS ord,
 c_mktsegment AS category,
 concat(CASE o_orderkey % 6 WHEN 0 THEN 'sale.sale' WHEN 1 THEN 'account.invoice' WHEN 2 THEN 'Invoice'
          WHEN 3 THEN 'order' WHEN 4 THEN 'account.invoice.pay.ask' ELSE o_orderpriority END, '.',
        CASE c_custkey % 3 WHEN 0 THEN 'custKey' WHEN 1 THEN 'GTINCode' ELSE 'Ship-To Name' END,
        CAST(c_custkey % 100 AS STRING)) AS name,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE c_name END AS title,
 CASE o_orderkey % 5
   WHEN 0 THEN NULL
   WHEN 1 THEN concat(c_name, ' (links to ', CASE o_orderkey % 6 WHEN 0 THEN 'Invoice' WHEN 3 THEN 'Invoice'
          WHEN 4 THEN 'order' WHEN 5 THEN 'account.invoice.pay.ask' ELSE 'Customer' END, ')')
   WHEN 2 THEN concat('<b>', o_orderpriority, '</b> total (references order, invoice)')
   WHEN 3 THEN concat(c_mktsegment, ' (collection of order)')
   ELSE concat('Placed by ', c_name) END AS description,
 CASE o_orderkey % 11 WHEN 0 THEN 'VARCHAR' WHEN 1 THEN 'TEXT' WHEN 2 THEN 'INTEGER' WHEN 3 THEN 'DECIMAL'
   WHEN 4 THEN 'BOOLEAN' WHEN 5 THEN 'DATE' WHEN 6 THEN 'DATETIME' WHEN 7 THEN 'RELATION'
   WHEN 8 THEN 'OBJECT' WHEN 9 THEN 'BLOB' ELSE 'BIGINT' END AS data_type,
 CASE WHEN o_orderkey % 22 = 0 THEN CAST(o_orderkey % 300 AS INT) END AS byte_length,
 CASE WHEN o_orderkey % 11 = 3 THEN CAST(o_orderkey % 4 AS INT) END AS decimal_scale,
 o_orderkey % 7 < 2 AS is_required,
 CASE (o_orderkey % 11) % 3 WHEN 0 THEN concat('["', o_orderstatus, '","', r_name, '"]')
   WHEN 1 THEN '["F","O","P"]' END AS allowed_values,
 CASE WHEN o_orderkey % 17 = 0 THEN 'N14,csum' END AS format_mask,
 r_name AS source_standard,
 concat('https://example.org/', lower(r_name), '/', CAST(o_orderkey % 40 AS STRING)) AS source_url,
 concat('v', CAST(o_orderkey % 3 AS STRING)) AS version
FROM $orders JOIN $customer ON o_custkey = c_custkey
 JOIN $nation ON c_nationkey = n_nationkey JOIN $region ON n_regionkey = r_regionkey
"""

LINE_FIELDS = """
SELECT l_orderkey AS doc_id, l_linenumber AS line_no, concat('Order', CAST(l_orderkey % 40 AS STRING)) AS entity,
 CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE concat('partKey', CAST(l_partkey % 60 AS STRING)) END AS fieldname,
 CASE l_partkey % 6 WHEN 0 THEN 'Data' WHEN 1 THEN 'Int' WHEN 2 THEN 'Currency' WHEN 3 THEN 'Select'
  WHEN 4 THEN 'Link' ELSE 'Section Break' END AS native_type,
 CASE l_partkey % 6 WHEN 3 THEN concat(l_returnflag, '|', l_linestatus)
  WHEN 4 THEN concat('Supplier', CAST(l_suppkey % 5 AS STRING)) END AS options,
 CAST(l_quantity AS INT) AS max_len, l_returnflag = 'R' AS reqd FROM $lineitem
"""

EVENT_PROPS = """
SELECT event_id, concat('{"', CASE WHEN event_id % 2 = 0 THEN 'components":{"schemas":' ELSE 'definitions":' END,
 '{"', event_type, '":{"required":["k1"],"properties":{"k', CAST(event_id % 3 AS STRING), '":',
 CASE event_id % 7 WHEN 0 THEN '{"type":"string","format":"date-time"}' WHEN 1 THEN '{"type":"integer","maxLength":9}'
  WHEN 2 THEN '{"type":["null","number"]}' WHEN 3 THEN '{"anyOf":[{"$$ref":"#/x"},{"type":"string"}]}'
  WHEN 4 THEN '{"$$ref":"#/y"}' WHEN 5 THEN '{"type":"string","enum":["a","b"]}' ELSE '{"description":"untyped"}' END,
 '}}}', CASE WHEN event_id % 2 = 0 THEN '}}' ELSE '}' END) AS doc FROM $events
"""

SPEC_LINES = """
SELECT p_partkey AS ord, CASE p_partkey % 25 WHEN 0 THEN concat('# ', p_name) WHEN 1 THEN ''
 ELSE concat(CASE WHEN p_partkey % 10 = 2 THEN lpad(CAST(p_partkey % 100 AS STRING), 2, '0')
   ELSE lpad(CAST((p_partkey * 37) % 10000 AS STRING), 4, '0') END,
  CASE p_partkey % 3 WHEN 0 THEN '  *?' WHEN 1 THEN ' *' ELSE '' END, '  ',
  CASE p_partkey % 5 WHEN 0 THEN 'N14,csum' WHEN 1 THEN 'N6,yymmd0' WHEN 2 THEN 'X..20'
   WHEN 3 THEN 'N3,iso4217 N..15' ELSE 'N6,yymmdd N4,hhmi' END,
  CASE p_partkey % 4 WHEN 0 THEN ' ex=255,37' WHEN 1 THEN ' dlpkey' ELSE '' END, '   # ', upper(p_name)) END AS line
FROM $part
"""

PART_TREE = """
SELECT p_partkey + 1 AS node,
 CASE WHEN p_partkey > 0 THEN CAST(floor((p_partkey + 1) / 2) AS BIGINT) END AS parent FROM $part
"""

PART_PROPS = """
SELECT DISTINCT p_brand AS prop, CAST(1 + p_partkey % 50 AS BIGINT) AS domain_node FROM $part
"""

DOC_TYPES = """
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'Reference|string' WHEN 1 THEN 'http://h/System.String'
  WHEN 2 THEN 'HumanName' WHEN 3 THEN 'dateTime' WHEN 4 THEN 'xhtml' ELSE '' END AS codes,
 CASE WHEN doc_id % 6 = 0 THEN concat('http://h/', source, '|http://h/Doc', lang, '|http://h/', source) END AS target_profiles,
 CASE doc_id % 4 WHEN 0 THEN 'required' WHEN 1 THEN 'extensible' WHEN 2 THEN 'example' END AS strength,
 concat('http://h/vs/', lang, '-', source, '|4.0.1') AS value_set,
 CASE doc_id % 5 WHEN 0 THEN 'schema:Text|schema:Integer' WHEN 1 THEN 'schema:URL'
  WHEN 2 THEN 'schema:Person|schema:Order' WHEN 3 THEN 'schema:Date|schema:DateTime' ELSE 'schema:Boolean' END AS ranges
FROM $documents
"""

CURATED = """
SELECT concat('invoice.cust_key', CAST(p_partkey % 120 AS STRING)) AS name, min(p_name) AS description FROM $part GROUP BY 1
"""

CATEGORY_NAMES = """
SELECT DISTINCT c_mktsegment AS name FROM $customer UNION ALL SELECT 'EMPTY' AS name
"""

TERMS = """
SELECT * FROM (VALUES (1,'machinery'),(2,'invoice'),(3,'billing'),(4,'customer#0000001'),(5,'order'),
 (6,'urgent'),(7,'account'),(8,'zzz')) AS t(term_pos, term)
"""

ALIASES = """
SELECT * FROM (VALUES ('billing',1,'invoice'),('billing',2,'order'),('urgent',1,'1_urgent'),('urgent',2,'BUILDING'),
 ('payee',1,'account.invoice.pay')) AS t(term, target_pos, target)
"""

# Entity and field equivalences of the test catalog.
ENTITY_ALIASES = {"account.invoice": "invoice", "sale.sale": "order"}
FIELD_ALIASES = {"invoice.gtin_code1": "order.gtin_code1", "1_urgent.gtin_code2": "order.gtin_code2"}

VIEWS = {
    "raw_items": RAW_ITEMS, "line_fields": LINE_FIELDS, "event_props": EVENT_PROPS, "spec_lines": SPEC_LINES,
    "part_tree": PART_TREE, "part_props": PART_PROPS, "doc_types": DOC_TYPES, "curated": CURATED,
    "category_names": CATEGORY_NAMES, "terms": TERMS, "aliases": ALIASES,
}


SPREAD = "spark.fieldloom.scan.tasks"
#: Sources of the test catalog.
SOURCES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One input table; its schema is read from the files once per session.

    A session that sets ``SPREAD`` gets its tables dealt out over so many tasks:
    a setting for few cores and files of one row group, such as the bench has.
    """
    path = f"{root}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[key]).parquet(path)
    tasks = spark.conf.get(SPREAD, None)
    return df.repartition(int(tasks)) if tasks else df


def view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A derived view as a lazy DataFrame over the tables below ``root``."""
    text = VIEWS[name].replace("{", "{{").replace("}", "}}")
    used = {t: table(spark, root, t) for t in TABLES if f"${t}" in text}
    return spark.sql(Template(text).substitute({t: "{" + t + "} AS " + t for t in used}), **used)


def view_sql(name: str) -> str:
    """The same view over tables registered under their plain names."""
    return Template(VIEWS[name]).substitute({t: t for t in TABLES}).strip()


# JSON documents built from line fields (the oracle reads the line fields themselves). The parts of the entity's document
# are names and numbers, which need no quoting; parts that are NULL are left out.
ORDER_DOCS = f"""
SELECT doc_id, line_no, entity,
 concat('{{"definitions":[{{"entityName":"Other","hasAttributes":[{{"attributeGroupReference":{{"members":[{{"name":"decoy","dataType":"string","maximumLength":1,"isNullable":true}}]}}}}]}},{{',
  concat_ws(',', concat('"entityName":"', entity, '"'), concat('"hasAttributes":[{{"attributeGroupReference":{{"members":[{{"name":"untyped","maximumLength":1,"isNullable":true}},{{',
   concat_ws(',', concat('"name":"', fieldname, '"'), concat('"dataType":', CASE native_type WHEN 'Data' THEN '"string"' WHEN 'Int' THEN '"integer"'
      WHEN 'Currency' THEN '"currency"' WHEN 'Select' THEN '{{"dataTypeReference":"listLookup"}}' WHEN 'Link' THEN '"partyLink"' END),
    CASE WHEN reqd THEN concat('"description":"Line ', CAST(line_no AS STRING), '"') END, concat('"maximumLength":', CAST(max_len AS STRING)),
    concat('"isNullable":', CAST(NOT reqd AS STRING))), '}}]}}}},{{"attributeGroupReference":{{"members":[{{"name":"rowVersion","dataType":"bigInteger"}}]}}}}]')), '}}]}}') AS entity_doc,
 to_json(named_struct('name', entity, 'fields', array(
  named_struct('fieldtype', 'Button', 'fieldname', 'press', 'options', NULL, 'reqd', 0, 'length', 0),
  named_struct('fieldtype', native_type, 'fieldname', fieldname, 'options', replace(options, '|', '\\n'),
   'reqd', CASE WHEN reqd THEN 1 ELSE 0 END, 'length', max_len - 1)))) AS form_doc,
 to_json(named_struct('snapshot', named_struct('element', array(
  named_struct('path', entity, 'min', 0, 'definition', 'root', 'type', NULL, 'binding', NULL),
  named_struct('path', concat(entity, '.id'), 'min', 1, 'definition', NULL, 'type', NULL, 'binding', NULL),
  named_struct('path', concat(entity, CASE WHEN line_no % 2 = 0 THEN '.a.' ELSE '.' END, fieldname),
   'min', CASE WHEN reqd THEN 1 ELSE 0 END, 'definition', CASE WHEN max_len % 3 > 0 THEN concat('Up to ', CAST(max_len AS STRING)) END,
   'type', array(named_struct('code', CASE native_type WHEN 'Data' THEN 'string' WHEN 'Int' THEN 'positiveInt' WHEN 'Currency' THEN 'Money'
     WHEN 'Select' THEN 'code' WHEN 'Link' THEN 'Reference' ELSE 'xhtml' END,
     'targetProfile', CASE native_type WHEN 'Link' THEN array(concat('http://h/', options), 'http://h/Any') END)),
   'binding', CASE native_type WHEN 'Select' THEN named_struct('strength', CASE WHEN reqd THEN 'required' ELSE 'example' END,
     'valueSet', concat('http://h/vs/', replace(options, '|', '-'), '|4.0.1')) END))))) AS resource_doc
FROM ({LINE_FIELDS})
"""
VIEWS["order_docs"] = ORDER_DOCS

# The same with a line number of its own for every line: equal numbers of an order count on by eight.
LINES = LINE_FIELDS.replace("l_linenumber AS line_no", """l_linenumber + 8 * CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) - 1 AS INT) AS line_no""")
VIEWS["lines"] = LINES
VIEWS["line_docs"] = ORDER_DOCS.replace(LINE_FIELDS, LINES)


def line_docs(spark: SparkSession, root: str) -> DataFrame:
    """The view of that name over lines written once: their numbers are a window, which each reader of a document would ask for anew."""
    lines = materialize(view(spark, root, "lines"), "lines")
    text = ORDER_DOCS.replace("{", "{{").replace("}", "}}").replace(f"({LINE_FIELDS})", "{lines}")
    return spark.sql(text, lines=lines)

# A vocabulary as graph documents: parts as classes, brands as properties, part names as members of enumerations below class 2.
GRAPH_DOCS = f"""
SELECT doc_id, concat('{{"@context":{{}},"@graph":["odd",', array_join(array_sort(collect_list(body)), ','), ']}}') AS doc FROM (
 SELECT node div 50 AS doc_id, concat('{{"@id":"schema:C', node, '","@type":"rdfs:Class","rdfs:label":"C', node, '"',
  CASE WHEN node = 2 THEN ',"rdfs:subClassOf":[{{"@id":"schema:C1"}},{{"@id":"schema:Enumeration"}}]' WHEN parent IS NULL THEN ''
   WHEN node % 2 = 0 THEN concat(',"rdfs:subClassOf":{{"@id":"schema:C', parent, '"}}') ELSE concat(',"rdfs:subClassOf":[7,{{"@id":"schema:C', parent, '"}}]') END, '}}') AS body FROM ({PART_TREE})
 UNION ALL SELECT p_partkey div 50, concat('{{"@id":"schema:M', p_partkey, '","@type":', CASE WHEN p_partkey % 3 = 0 THEN concat('["x:y","schema:C', 1 + p_partkey % 50, '"]')
  ELSE concat('"schema:C', 1 + p_partkey % 50, '"') END, ',"rdfs:label":"', p_name, '"}}') FROM $part
 UNION ALL SELECT n % 7, concat('{{"@id":"schema:', replace(prop, '#', ''), '","@type":"rdf:Property","rdfs:label":', CASE WHEN n % 5 = 0 THEN 'null' ELSE concat('"', lower(prop), '"') END,
  CASE WHEN n % 4 = 0 THEN '' ELSE concat(',"rdfs:comment":"<b>Brand</b>  no ', n, '"') END, ',"schema:domainIncludes":[', domains, '],"schema:rangeIncludes":',
  CASE n % 5 WHEN 0 THEN '{{"@id":"schema:Text"}}' WHEN 1 THEN '[{{"@id":"schema:Person"}},{{"@id":"schema:C4"}}]' WHEN 2 THEN '{{"@id":"schema:C3"}}'
   WHEN 3 THEN '[{{"@id":"schema:C9"}},{{"@id":"schema:Date"}},{{"@id":"schema:DateTime"}}]' ELSE 'null' END, '}}')
  FROM (SELECT prop, CAST(substr(prop, 7) AS BIGINT) AS n, array_join(array_sort(collect_list(concat('{{"@id":"schema:C', domain_node, '"}}'))), ',') AS domains FROM ({PART_PROPS}) GROUP BY prop)
 UNION ALL SELECT 0, '{{"@id":"schema:Enumeration","@type":"rdfs:Class"}}' FROM (SELECT 1)
) GROUP BY doc_id
"""
VIEWS["graph_docs"] = GRAPH_DOCS

# Program texts: five declarations each, ``~`` standing for a quote; in some a bracket is missing or one too many.
PROGRAM_TEXTS = """
SELECT doc_id, replace(concat(CASE WHEN doc_id % 11 = 5 THEN ')' ELSE '' END, array_join(array_sort(collect_list(concat(lpad(CAST(ord AS STRING), 12, '0'), '#', body))), '\\n'),
 CASE WHEN doc_id % 11 = 3 THEN '\\nopen = fields.Char("open"' ELSE '' END), '~', chr(39)) AS text FROM (
 SELECT p_partkey div 5 AS doc_id, p_partkey AS ord, concat('\\n', CASE p_partkey % 5
  WHEN 0 THEN concat('f', p_partkey, ' = fields.Selection([("a', p_size, '", ~', p_brand, ' (x)~), (~b]~, _("It~s")), "c,(" ], string="', p_name, '", required=True)')
  WHEN 1 THEN concat('f', p_partkey, ' = fields.Many2one(~res.', lower(p_type), '~, "', p_name, '")  # note (')
  WHEN 2 THEN concat('x = [1, (2)]\\nf', p_partkey, ' = fields.Float(digits=(16, 2), help="(none)")')
  WHEN 3 THEN concat('f', p_partkey, ' = Char(~', p_type, '~, size=', p_size, ')')
  ELSE concat('f', p_partkey, ' = fields.Text()\\ny = other.Thing("z")') END) AS body FROM $part) GROUP BY doc_id
"""
VIEWS["program_texts"] = PROGRAM_TEXTS

# Category declarations of the sources; one category is in use without being declared.
DECLARED = f"""
SELECT DISTINCT category AS name, source_standard AS source, category <> 'FURNITURE' AS is_declared,
 CASE WHEN source_standard <> 'ASIA' THEN concat('Items of ', category, ' by ', source_standard) END AS description
FROM ({RAW_ITEMS})
"""
VIEWS["declared"] = DECLARED
