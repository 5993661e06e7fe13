"""Sources, extraction out of documents, and file sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import entity_of
from ..literals import literal_table
from ..operators import graph as G
from ..operators import harmonize as H
from ..operators import upsert as U
from ..operators.ranges import match_ranges
from ..operators.tours import inherited
from ..sources import blocks as B
from ..sources import documents as D
from ..sources import loaders as L
from ..sources import markup as M
from ..sources import sinks as K
from ..sources import speclines as S
from ..sources import textfiles as T
from ..sources.tables import SOURCES, line_docs, table, view
from ..sources.typemaps import VOCABULARY, map_types
from ..sources.vocabulary import vocabulary_items
from ..storage import new_path
from .catalog import _snapshot, catalog, merged

# Fixed values of the test bindings.
ROUTES = {"Finance": ["Invoice", "account.invoice"], "Sales": ["order", "sale.sale"]}
BASE_URL = "https://example.org/schema/"
SOURCE_KINDS = {"AFRICA": "cdm", "AMERICA": "odoo", "ASIA": "tryton", "EUROPE": "fhir", "MIDDLE EAST": "openapi"}
ENUM_ROOT = 2
EXPORT_CATEGORY, EXPORT_ENTITY = "MACHINERY", "invoice"


def load_sources(spark, root):
    """Each source in a table of its own, some without optional columns."""
    raw = view(spark, root, "raw_items")
    path = new_path(spark, "sources")
    raw.hint("rebalance", "source_standard").write.partitionBy("source_standard").parquet(path)
    absent = {"AFRICA": ["version"], "ASIA": ["format_mask", "title"]}
    frames = {}
    for name in SOURCES:
        columns = [f for f in raw.schema if f.name != "source_standard" and f.name not in absent.get(name, [])]
        frames[name] = spark.read.schema(StructType(columns)).parquet(f"{path}/source_standard={name}")
    return L.union_sources(frames).select("ord", "category", "name", "title", "format_mask", "default_value", "version", "source_standard")


def declared(spark, root):
    """Declarations in source order."""
    return view(spark, root, "declared").filter("is_declared").withColumn("seq", F.col("source"))


def type_lookup(spark, root):
    kinds = [F.lit(x) for kv in SOURCE_KINDS.items() for x in kv]
    rows = view(spark, root, "raw_items").select("ord", F.element_at(F.create_map(*kinds), F.col("source_standard")).alias("kind"), "data_type")
    native = F.when(F.col("kind").isin("odoo", "tryton"), F.initcap("data_type")).otherwise(F.lower("data_type"))
    return map_types(rows.select("ord", "kind", native.alias("native_type"))).select("ord", "kind", "native_type", "data_type")


def _docs(spark, root, *columns):
    return view(spark, root, "order_docs").select("doc_id", "line_no", *columns)


def entity_attributes(spark, root):
    rows = D.entity_attributes(_docs(spark, root, "entity", "entity_doc"), "entity_doc", "entity", ["doc_id", "line_no", "entity"])
    return rows.select("doc_id", "line_no", "entity", "attribute", "title", "data_type", "byte_length", "is_required")


def option_sets(spark, root):
    rows = D.entity_attributes(_docs(spark, root, "entity", "entity_doc"), "entity_doc", "entity", ["doc_id", "line_no", "entity"])
    return rows.select("doc_id", "line_no", "attribute", "is_option_set", "description")


def form_fields(spark, root):
    return D.doctype_fields(_docs(spark, root, "form_doc"), "form_doc", ["doc_id", "line_no"])


def resource_elements(spark, root):
    return D.path_elements(_docs(spark, root, "resource_doc"), "resource_doc", ["doc_id", "line_no"])


def schema_properties(spark, root):
    return D.schema_properties(view(spark, root, "event_props"), "doc", ["event_id"])


def _doc_types(spark, root):
    split = lambda c: F.filter(F.split(c, r"\|"), lambda x: x != "")
    return view(spark, root, "doc_types").select(
        "doc_id", split("codes").alias("codes"), split("target_profiles").alias("targets"), "strength", "value_set",
        split("ranges").alias("ranges"))


def reference_targets(spark, root):
    data_type, note = D.reference_type(F.col("codes"), F.col("targets"))
    return _doc_types(spark, root).select("doc_id", data_type.alias("data_type"), note.alias("note"))


def bindings(spark, root):
    return _doc_types(spark, root).select("doc_id", D.binding_note(F.col("strength"), F.col("value_set")).alias("note"))


def range_types(spark, root):
    data_type, note = L.pick_range(F.col("ranges"), VOCABULARY)
    return _doc_types(spark, root).select("doc_id", data_type.alias("data_type"), note.alias("note"))


def _lines(spark, root):
    return S.parse_lines(view(spark, root, "spec_lines"))


SPEC_FOLDERS, BAD_FOLDER = 4, 3


def _spec_files(spark, root):
    """The spec lines as text files, dealt over folders in their order; in one folder every line has a byte that is no text."""
    path = new_path(spark, "spec-files")
    rows = view(spark, root, "spec_lines").withColumn("folder", F.col("ord") % SPEC_FOLDERS)
    broken = F.concat(F.col("line").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    value = F.when(F.col("folder") == BAD_FOLDER, broken).otherwise(F.col("line"))
    rows.repartitionByRange("folder", "ord").sortWithinPartitions("folder", "ord").select("folder", value.alias("value")).write.partitionBy("folder").text(path)
    return T.read_lines(spark, path)


def spec_file_items(spark, root):
    """Definition lines out of files, with their number over all files and names that do not repeat."""
    return S.unique_names(S.parse_lines(_spec_files(spark, root)[0])).select("ord", "code", "spec", "name")


def rejected_files(spark, root):
    folder = F.regexp_extract("file", "folder=([0-9]+)", 1).cast("int")
    rejects = _spec_files(spark, root)[1]
    return rejects.groupBy(folder.alias("folder"), "reason").agg(F.sum("lines").alias("lines"), F.max("first_bad").alias("first_bad"))


def spec_classes(spark, root):
    c, s = F.col("code"), F.col("spec")
    return _lines(spark, root).select("ord", "code", S.spec_type(c, s).alias("data_type"), S.spec_length(s).alias("byte_length"))


def order_ranges(spark, root):
    """Order keys and the overlapping ranges of keys that customers span, of which the smallest customer wins."""
    spans = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("priority")).agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    spans = spans.withColumn("hi", F.least("hi", F.col("lo") + 2000))
    found = match_ranges(table(spark, root, "orders").select("o_orderkey"), "o_orderkey", spans)
    return found.groupBy("o_orderkey").agg(F.min("priority").alias("first"), F.count("*").alias("ranges"))


def spec_descriptions(spark, root):
    return _lines(spark, root).select("ord", "code", S.describe(F.col("code"), F.col("title"), F.col("spec")).alias("description"))


def closure(spark, root):
    return _snapshot(spark, root, "closure", lambda: G.transitive_closure(view(spark, root, "part_tree"), "node", "parent"))


def irregular_tree(spark, root):
    """The tree of parts, with further parents, two cycles and a domain on one of them."""
    tree = view(spark, root, "part_tree")
    more = tree.filter("node % 97 = 5").select("node", F.expr("node div 3 + 1").alias("parent"))
    cycles = literal_table(spark, ["node", "parent"], [(2, 9), (-1, -2), (-2, -3), (-3, -1), (-4, -2)]).selectExpr("cast(node AS bigint) AS node", "cast(parent AS bigint) AS parent")
    props = view(spark, root, "part_props")
    return tree.unionByName(more).unionByName(cycles), props.unionByName(spark.sql("SELECT 'ring' AS prop, CAST(-3 AS BIGINT) AS domain_node"))


def vocabulary(spark, root):
    """Items of some classes of a vocabulary given as graph documents."""
    targets = view(spark, root, "part_tree").filter("node % 9 = 1").select(
        F.concat(F.lit("C"), F.col("node").cast("string")).alias("type"), F.concat(F.lit("Group "), (F.col("node") % 4).cast("string")).alias("category"))
    return vocabulary_items(view(spark, root, "graph_docs"), targets)


FIELD_KINDS = {"Selection": "VARCHAR", "Many2one": "RELATION", "Float": "DECIMAL", "Char": "VARCHAR", "Text": "TEXT"}


def _programs(spark, root):
    return view(spark, root, "program_texts")


def enum_members(spark, root):
    members = table(spark, root, "part").select(
        (F.lit(1) + F.col("p_partkey") % 50).alias("node"), F.col("p_name").alias("label"))
    return G.enumeration_members(closure(spark, root), members, ENUM_ROOT)


def enumeration_ranges(spark, root):
    """Ranges of which some are classes below the enumeration root, some other classes, some scalars."""
    node = F.concat(F.lit("schema:C"), (F.lit(1) + F.col("doc_id") % 50).cast("string"))
    rows = _doc_types(spark, root).withColumn("ranges", F.when(F.col("doc_id") % 2 == 0, F.concat("ranges", F.array(node))).otherwise(F.col("ranges")))
    members = enum_members(spark, root).select(F.concat(F.lit("schema:C"), F.col("node").cast("string")).alias("range"), "labels")
    return L.typed_ranges(rows, "doc_id", "ranges", VOCABULARY, members)


def relation_notes(spark, root):
    relation = F.expr("CASE ord % 4 WHEN 0 THEN 'single' WHEN 1 THEN 'multi' WHEN 2 THEN 'repeat' END")
    comodel = F.expr("CASE WHEN ord % 3 > 0 THEN lower(category) END")
    return view(spark, root, "raw_items").select(
        "ord", L.relation_note(F.col("description"), F.col("title"), relation, comodel).alias("description"))


def structure_notes(spark, root):
    """Items of which the types are simple, composite, nested or missing."""
    names = ["IdentifierType", "DescriptionType", "DateTimeType", "ValueType", "QuantityValueType", "StatusType", "ResourceLocationType"]
    native = F.try_element_at(F.array(*map(F.lit, names)), (F.col("ord") % 8 + 1).cast("int"))
    data_type, text = L.structured_type(native, F.col("title"), F.col("ord") % 3 == 0)
    return view(spark, root, "raw_items").select("ord", data_type.alias("data_type"), text.alias("description"))


def routes(spark, root):
    entity = entity_of(F.col("name"))
    return view(spark, root, "raw_items").select(
        "ord", entity.alias("entity"), L.route_entity(entity, ROUTES, "Common", BASE_URL).alias("source_url"))


def upsert_categories(spark, root):
    rows = declared(spark, root)
    side = lambda names: U.latest_values(rows.filter(F.col("source").isin(names)), ["name"], ["description", "source"], "seq")
    return U.upsert_categories(side(["AFRICA", "AMERICA", "MIDDLE EAST"]), side(["ASIA", "EUROPE"]))


def extracted(spark, root):
    """Items of five kinds of documents in one raw table: each reader's rows with category, position and address."""
    docs = line_docs(spark, root)
    at = F.col("doc_id") * 1024 + F.col("line_no")
    area = F.concat(F.lit("Area "), (F.col("doc_id") % 40 % 5).cast("string"))
    where = F.concat(F.lit(BASE_URL), F.col("doc_id").cast("string"))
    placed = lambda rows, position: rows.withColumns({"category": area, "position": position, "source_url": where})
    cdm = D.entity_attributes(docs, "entity_doc", "entity", ["doc_id", "line_no", "entity"])
    cdm = cdm.withColumn("name", F.concat_ws(".", "entity", "attribute")).drop("entity", "attribute")
    spec = S.unique_names(_lines(spark, root)).withColumns({
        "category": S.code_category(F.col("code")), "position": F.col("ord"), "data_type": S.spec_type(F.col("code"), F.col("spec")), "byte_length": S.spec_length(F.col("spec")),
        "description": S.describe(F.col("code"), F.col("title"), F.col("spec"))}).drop("ord")
    return L.union_sources({
        "cdm": placed(cdm, at * 2 + (F.col("title") == "rowVersion").cast("int")),
        "fhir": placed(D.path_elements(docs, "resource_doc", ["doc_id", "line_no"]), at),
        "frappe": placed(D.doctype_fields(docs, "form_doc", ["doc_id", "line_no"]), at),
        "gs1": spec,
        "openapi": schema_properties(spark, root).withColumns({"category": F.lit("Events"), "position": F.col("event_id")}),
    })


def extracted_catalog(spark, root):
    """From documents to the catalog: read, united, brought to one form of names, merged."""
    items = H.merge_items(H.normalize_items(extracted(spark, root), {"order1": "order0"}, {}))
    return items.select("category", "name", "title", "description", "data_type", "byte_length", "is_required", "allowed_values", "source_standard", "n_members", "n_sources")


def rejected_documents(spark, root):
    """Documents that give nothing, out of a set of which some are cut off, of another form, or missing."""
    k = F.col("doc_id") % 13
    doc = F.when(k == 1, F.substring("entity_doc", 1, 20)).when(k == 2, '{"definitions":5}').when(k == 4, "{}").when(k != 3, F.col("entity_doc"))
    return D.rejected_documents(_docs(spark, root, doc.alias("entity_doc")), "entity_doc", ["doc_id", "line_no"], "definitions")


QUERIES = {
    "load_sources": load_sources,
    "derive_categories": lambda s, r: U.derive_categories(declared(s, r), H.conform(view(s, r, "raw_items"))),
    "upsert_categories": upsert_categories,
    "extracted_catalog": extracted_catalog,
    "rejected_documents": rejected_documents,
    "json_entity_attrs": entity_attributes,
    "json_field_list": form_fields,
    "json_schema_props": schema_properties,
    "json_path_elements": resource_elements,
    "anyof_type_resolve": lambda s, r: schema_properties(s, r).select("event_id", "name", "data_type"),
    "reference_targets": reference_targets,
    "valueset_binding": bindings,
    "type_map_lookup": type_lookup,
    "optionset_flag": option_sets,
    "spec_line_parse": lambda s, r: _lines(s, r).select("ord", "code", "spec", "title"),
    "spec_classify": spec_classes,
    "spec_file_items": spec_file_items,
    "rejected_files": rejected_files,
    "range_join": lambda s, r: S.categorize(_lines(s, r), *S.category_table(s), S.DEFAULT_CATEGORY).select("ord", "code", "category"),
    "range_join_orders": order_ranges,
    "range_categorize": lambda s, r: _lines(s, r).select("ord", "code", S.code_category(F.col("code")).alias("category")),
    "slug_unique": lambda s, r: S.unique_names(_lines(s, r)).select("ord", "code", "name"),
    "spec_describe": spec_descriptions,
    "strip_markup": lambda s, r: table(s, r, "pages").select("page_id", M.strip_markup(F.col("html")).alias("text")),
    "class_closure": closure,
    "inherited_properties": lambda s, r: G.inherited_properties(closure(s, r), view(s, r, "part_props")),
    "inherited_by_interval": lambda s, r: inherited(view(s, r, "part_tree"), view(s, r, "part_props")),
    "inherited_irregular": lambda s, r: inherited(*irregular_tree(s, r)),
    "vocabulary_items": vocabulary,
    "enum_members": enum_members,
    "range_type_pick": range_types,
    "range_enumeration": enumeration_ranges,
    "declared_fields": lambda s, r: B.declared_fields(_programs(s, r), ["doc_id"], "text", FIELD_KINDS),
    "declared_options": lambda s, r: B.declared_options(B.tokens(_programs(s, r), ["doc_id"], "text"), ["doc_id"], ["selection"]).select("doc_id", "name", "option", "code", "label"),
    "declaration_extract": lambda s, r: M.declarations(table(s, r, "pages")),
    "relation_note": relation_notes,
    "structure_note": structure_notes,
    "per_entity_counts": lambda s, r: L.extraction_counts(view(s, r, "raw_items"), entity_of(F.col("name"))),
    "source_file_route": routes,
    "write_catalog": lambda s, r: K.write_catalog(merged(s, r)),
    "export_csv": lambda s, r: K.export_csv(catalog(s, r), EXPORT_CATEGORY)[1],
    "export_entity_json": lambda s, r: K.export_entity_json(catalog(s, r), EXPORT_ENTITY)[1],
}
