"""Search, graphs, ranking, upserts, documents and files."""

import json
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import graph as G
from fieldloom.operators import harmonize as H
from fieldloom.operators import ranking, schema, search
from fieldloom.operators import upsert as U
from fieldloom.operators.projection import longest_prefix_parent
from fieldloom.plans import catalog as plans
from fieldloom.sources import documents as D
from fieldloom.sources import loaders as L
from fieldloom.sources import sinks as K
from fieldloom.sources.typemaps import VOCABULARY
from fieldloom.storage import new_path
from fieldloom.streaming import upsert_stream as T


@pytest.fixture
def catalog(items):
    names = ["invoice.total", "invoice_line.qty", "invoice.line.tax", "invoices.x", "order.id", "stock.lot.a%b", "Stock.lot.name"]
    rows = [dict(name=n, title=f"Title {i}", description="Sales tax" if i == 0 else None) for i, n in enumerate(names)]
    return H.merge_items(items(*rows, dict(category="Order Desk", name="desk.phone"), dict(category="Order Desk", name="invoice.total")))


def resolved(spark, catalog, terms, aliases=()):
    t = spark.createDataFrame([(i, x) for i, x in enumerate(terms)], "term_pos int, term string")
    a = spark.createDataFrame(list(aliases) or [("-", 1, "-")], "term string, target_pos int, target string")
    out = {}
    for r in search.resolve(catalog.select("category", "name", "title", "description"), t, a).collect():
        out.setdefault((r["term"], r["level"]), []).append(r["name"])
    return {k: sorted(v) for k, v in out.items()}


def test_search_levels(spark, catalog):
    aliases = [("billing", 1, "invoice"), ("billing", 2, "order"), ("phones", 1, "desk"), ("void", 1, "nothing")]
    got = resolved(spark, catalog, ["ORDER", "Invoice", "billing", "phones", "tax", "void", "a%b", "t_tle 4"], aliases)
    assert got == {
        ("ORDER", "category"): ["desk.phone", "invoice.total"],
        ("Invoice", "entity"): ["invoice.line.tax", "invoice.total", "invoice.total", "invoice_line.qty"],
        ("billing", "alias"): ["invoice.line.tax", "invoice.total", "invoice_line.qty", "order.id"],
        ("phones", "alias"): ["desk.phone"],
        ("tax", "keyword"): ["invoice.line.tax", "invoice.total"],
        ("a%b", "keyword"): ["stock.lot.a%b"],
        ("t_tle 4", "keyword"): ["order.id"],
    }


def test_any_number_of_terms_takes_one_path(spark, catalog):
    texts = ["tax", "title", "o", "lo", "a%b", "t_tle 4", "%", "zzz", "\\", "e.", "desk", "", "_", None, "TAX"]
    cols = ["name", "title", "description"]
    rows = catalog.select("category", "name", *[F.coalesce(F.lower(c), F.lit("")).alias(f"low_{c}") for c in cols]).collect()

    def occurs(term, row):
        pattern = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in term)
        return any(re.search(pattern, row[f"low_{c}"], re.S) for c in cols)

    want = sorted((r["category"], r["name"], t) for r in rows for t in texts if t is not None and occurs(t, r))
    for absent in (0, 186, 187, 5000):
        terms = spark.createDataFrame([(t,) for t in texts], "lookup string").union(spark.range(absent).selectExpr("concat('absent', id)"))
        got = search.match_substrings(catalog, ["category", "name"], cols, terms)
        assert sorted((r["category"], r["name"], r["lookup"]) for r in got.collect()) == want
    one = search.match_substrings(catalog, ["category", "name"], cols, spark.createDataFrame([("tax",)], "lookup string"))
    assert sorted(r["name"] for r in one.collect()) == sorted(n for _, n, t in want if t == "tax")


def test_top_n_and_union(spark, catalog):
    rows = catalog.select(F.lit(1).alias("term_pos"), F.lit("t").alias("term"), "category", "name")
    got = [(r["rank"], r["name"], r["more"]) for r in search.top_n(rows, 2).orderBy("rank").collect()]
    assert got == [(1, "Stock.lot.name", 7), (2, "desk.phone", 7)]
    several = rows.withColumn("term_pos", F.length("name") % 2)
    assert "WindowGroupLimit" in search.top_n(several, 2)._jdf.queryExecution().executedPlan().toString()
    assert search.union_terms(rows).count() == 8


def test_closure_with_cycle_and_diamond(spark):
    edges = [(1, None), (2, 1), (3, 1), (4, 2), (4, 3), (5, 4), (10, 11), (11, 12), (12, 10), (20, 99)]
    df = spark.createDataFrame(edges, "node bigint, parent bigint")
    got = {}
    for r in G.transitive_closure(df, "node", "parent").collect():
        got.setdefault(r["node"], []).append(r["ancestor"])
    assert {k: sorted(v) for k, v in got.items()} == {
        1: [1], 2: [1, 2], 3: [1, 3], 4: [1, 2, 3, 4], 5: [1, 2, 3, 4, 5],
        10: [10, 11, 12], 11: [10, 11, 12], 12: [10, 11, 12], 20: [20]}


def test_closure_of_a_long_chain(spark):
    df = spark.range(40).selectExpr("id AS node", "CASE WHEN id > 0 THEN id - 1 END AS parent")
    assert G.transitive_closure(df, "node", "parent").count() == 40 * 41 // 2


def test_dependency_levels(spark):
    tables = spark.createDataFrame([(t,) for t in "abcdefg"], "table_name string")
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("a", "a"), ("d", "e"), ("e", "d"), ("f", "e"), ("g", "out")],
                                  "child string, parent string")
    got = {r["table_name"]: r["level"] for r in G.dependency_levels(tables, edges).collect()}
    assert got == {"a": 0, "g": 0, "b": 1, "c": 2, "d": 3, "e": 3, "f": 3}


def test_enumeration_members(spark):
    closure = spark.createDataFrame([(1, 1), (2, 2), (2, 1), (3, 3)], "node bigint, ancestor bigint")
    members = spark.createDataFrame([(2, "b"), (2, "a"), (2, "b"), (3, "x"), (2, None)], "node bigint, label string")
    got = {r["node"]: r["labels"] for r in G.enumeration_members(closure, members, 1).collect()}
    assert got == {1: None, 2: '["a","b","b"]'}


def test_longest_prefix_parent(spark):
    df = spark.createDataFrame([(e,) for e in ["a", "a.b.c", "a.b.c.d", "ab", "x.y"]], "entity string")
    assert {r["entity"]: r["parent"] for r in longest_prefix_parent(df).collect()} == {
        "a": None, "a.b.c": "a", "a.b.c.d": "a.b.c", "ab": None, "x.y": None}


def test_global_rank(spark):
    df = spark.range(5000).selectExpr("id % 7 AS a", "sha2(string(id), 256) AS b").repartition(6)
    got = [(r["a"], r["b"]) for r in ranking.with_global_rank(df, ["a", "b"], "n").orderBy("n").collect()]
    assert got == sorted(got) and len(got) == 5000
    assert ranking.with_global_rank(df.limit(0), ["a", "b"], "n").count() == 0
    assert ranking.with_global_rank(df, ["a", "b"], "n", start=5).agg(F.min("n"), F.max("n"), F.count_distinct("n")).head() == (5, 5004, 5000)


def test_table_text(spark, items):
    cat = H.merge_items(items(
        dict(name="order.id_no", data_type="INTEGER", is_required=True), dict(name="order.order_id", data_type="INTEGER"),
        dict(name="order.invoice", description="(references invoice)", data_type="INTEGER"),
        dict(name="order.party", description="Who (links to Party)", data_type="VARCHAR", byte_length=20),
        dict(name="order.lines", description="(collection of order.line)"), dict(name="order.parent", description="(references order)"),
        dict(name="invoice.state", allowed_values='["a","b"]', data_type="VARCHAR", source_standard="S")))
    columns = schema.table_columns(cat)
    levels = schema.creation_levels(cat)
    lines = schema.create_table_lines(cat, columns, levels, ("postgres",))
    text = {r["table_name"]: r["text"] for r in schema.statements(lines).collect()}
    assert text["invoice"] == "\n".join([
        "-- invoice  (1 columns, 0 FKs)  [source: S]", "CREATE TABLE invoice (", "    invoice_id SERIAL PRIMARY KEY,",
        "    state VARCHAR(255) CHECK (state IN ('a', 'b'))", ");"])
    assert text["order"] == "\n".join([
        "-- order  (4 columns, 2 FKs)  [source: None]", "--   reverse relation: lines  (collection of order.line)",
        "CREATE TABLE order (", "    order_id SERIAL PRIMARY KEY,", "    id_no INTEGER NOT NULL,", "    invoice INTEGER,",
        "    parent INTEGER,", "    party VARCHAR(20),  -- external ref: Who (links to Party)",
        "    FOREIGN KEY (invoice) REFERENCES invoice(invoice_id),", "    FOREIGN KEY (parent) REFERENCES order(order_id)", ");"])
    assert {r["table_name"]: r["level"] for r in levels.collect()} == {"invoice": 0, "order": 1}


def batch(spark, *rows):
    cols = [*U.ITEM_KEY, *U.ITEM_COLUMNS]
    types = {"byte_length": "int", "decimal_scale": "int", "is_required": "boolean", "is_nullable": "boolean"}
    full = [dict(category="C", is_required=False, is_nullable=True, **r) for r in rows]
    schema_text = ", ".join(f"{c} {types.get(c, 'string')}" for c in cols)
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in full], schema_text)


def test_upsert(spark):
    base = batch(spark, dict(name="a", title="t", description="d"), dict(name="a", source_standard="S", title="s"), dict(name="old", title="o"))
    delta = batch(spark, dict(name="a", title="T"), dict(name="new", title="n"))
    once = U.upsert_items(base, delta)
    got = {(r["name"], r["source_standard"]): (r["title"], r["description"]) for r in once.collect()}
    assert got == {("a", None): ("T", "d"), ("a", "S"): ("s", None), ("old", None): ("o", None), ("new", None): ("n", None)}
    twice = U.upsert_items(once.select(base.columns), delta)
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()


def test_stream_in_any_order(spark):
    rows = [(0, dict(name="a", title="t0", description="d0")), (1, dict(name="a", title="t1")), (2, dict(name="b", title="b2")),
            (3, dict(name="a", description="d3", source_standard="S"))]
    frames = [batch(spark, r).withColumn(T.SEQ, F.lit(i)) for i, r in rows]
    want = None
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        source, log, state = (new_path(spark, p) for p in ("in", "log", "state"))
        for step, i in enumerate(order):
            frames[i].coalesce(1).write.parquet(f"{source}/step={step}")
        T.run(spark, frames[0].schema, source + "/*", log, state, files_per_trigger=1)
        T.run(spark, frames[0].schema, source + "/*", log, state)       # nothing new
        stored = T.read_log(spark, frames[0].schema, log)
        got = sorted(map(str, T.current_items(stored).collect()))
        assert want is None or got == want
        want = got
        small = T.still_needed(stored)
        assert sorted(map(str, T.current_items(small).collect())) == want
    assert len(want) == 3


def test_entity_attributes(spark):
    doc = {"definitions": [{"entityName": "X"}, {"entityName": "E", "hasAttributes": [
        {"attributeGroupReference": {"members": [
            {"name": "a", "dataType": "money", "displayName": "A", "isNullable": False},
            {"name": "b", "dataType": {"dataTypeReference": "listLookup"}}, {"name": "c"}, {"dataType": "string"},
            {"name": "d", "dataType": {"dataTypeReference": "other"}, "maximumLength": 5}]}},
        {"other": 1}]}]}
    df = spark.createDataFrame([(1, "E", json.dumps(doc)), (2, "none", json.dumps(doc)), (3, "E", "not json")], "id int, e string, doc string")
    got = [tuple(r) for r in D.entity_attributes(df, "doc", "e", ["id"]).orderBy("attribute").collect()]
    assert got == [(1, "a", "A", "A", False, "DECIMAL", None, True), (1, "b", "b", "Option-set (enumerated integer codes).", True, "INTEGER", None, False),
                   (1, "d", "d", None, False, "VARCHAR", 5, False)]


def test_property_types(spark):
    props = {"fmt": {"type": "string", "format": "date"}, "lst": {"type": ["null", "boolean"]}, "nolist": {"type": ["null"]},
             "any": {"anyOf": [{"x": 1}, {"type": "object"}]}, "ref": {"oneOf": [{"$ref": "#"}, {"type": "string"}]}, "all": {"allOf": [{"type": "weird"}], "$ref": "#"},
             "odd": {"type": "file"}, "flag": True, "uuid": {"type": "integer", "format": "uuid"}}
    doc = json.dumps({"components": {"schemas": {}}, "definitions": {"S": {"properties": props, "required": ["ref"]}}})
    df = spark.createDataFrame([(1, doc)], "id int, doc string")
    rows = D.schema_properties(df, "doc", ["id"]).collect()
    assert {r["title"]: r["data_type"] for r in rows} == {
        "fmt": "DATE", "lst": "BOOLEAN", "nolist": "VARCHAR", "any": "OBJECT", "ref": "RELATION", "all": "RELATION", "odd": "VARCHAR", "uuid": "INTEGER"}
    assert [r["title"] for r in rows if r["is_required"]] == ["ref"]


def test_range_pick(spark):
    df = spark.createDataFrame([(0, ["schema:Text", "schema:Date"]), (1, ["schema:Person", "schema:Size"]), (2, ["schema:Person", "x:y"]), (3, [])],
                               "i int, r array<string>")
    data_type, note = L.pick_range(F.col("r"), VOCABULARY, F.when(F.array_contains("r", "schema:Size"), "schema:Size"))
    assert [tuple(r)[1:] for r in df.select("i", data_type, note).orderBy("i").collect()] == [
        ("DATE", None), ("VARCHAR", "enumeration Size"), ("RELATION", "references Person"), ("RELATION", None)]


def test_union_of_sources_orders_by_source(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "position int, name string")
    b = spark.createDataFrame([(0, "z", "t")], "position int, name string, title string")
    rows = L.union_sources({"B": a, "A": b}).orderBy("ord").collect()
    assert [(r["source_standard"], r["name"], r["title"]) for r in rows] == [("A", "z", "t"), ("B", "x", None), ("B", "y", None)]


def local_parts(path):
    return [p.read_text() for p in sorted(pathlib.Path(path).glob("part-*"))]


def test_exported_files(spark, root):
    cat = plans.catalog(spark, root)
    path, back = K.export_entity_json(cat, "invoice")
    fields = json.loads("".join(local_parts(path)))
    assert [f["name"] for f in fields] == sorted(f["name"] for f in fields)
    assert len(fields) == cat.filter("name LIKE 'invoice.%'").count() > 0
    path, back = K.export_csv(cat, "MACHINERY")
    want = cat.filter("category = 'MACHINERY'").select(back.columns)
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()


def test_catalog_filters_reach_the_scan(spark, root):
    plan = plans.catalog(spark, root).filter("category = 'MACHINERY' AND name LIKE 'invoice.%'").select("name")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*category[^\]]*MACHINERY", text) and "StringStartsWith(name,invoice.)" in text


def test_positions_that_would_collide_are_an_error(spark):
    def load(position):
        return L.union_sources({"A": spark.createDataFrame([(position, "n")], "position bigint, name string")}).select("ord").collect()

    assert load((1 << 44) - 1)[0][0] == (1 << 44) - 1 and load(None)[0][0] is None
    with pytest.raises(Exception, match="beyond 44 bits"):
        load(1 << 44)


def test_equal_items_are_hit_once_each(spark):
    rows = spark.createDataFrame([("c", "invoice.total", "t", "x")] * 2 + [("c", "invoice.total", "other", "x")], "category string, name string, title string, description string")
    terms = spark.createDataFrame([(1, "invoice"), (2, "othe")], "term_pos int, term string")
    hits = [(r["term"], r["title"]) for r in search.search_keyword(rows, terms).collect()]
    assert sorted(hits) == [("invoice", "other"), ("invoice", "t"), ("invoice", "t"), ("othe", "other")]


def test_terms_meet_rows_by_their_rarest_part(spark):
    rows = spark.createDataFrame([("c", f"common.n{i}", "common words", "rare" if i == 7 else None) for i in range(60)], "category string, name string, title string, description string")
    found = spark.createDataFrame([("com", i) for i in range(60)] + [("rar", 7), ("are", 7), ("mon", 3)], "gram string, row int")
    wanted = spark.createDataFrame([("common%rare", g) for g in ("com", "mon", "rar", "are")] + [("com", "com"), ("comx", "com"), ("comx", "omx")], "lookup string, gram string")
    assert sorted(tuple(r) for r in search.anchors(found, wanted).collect()) == [("com", "com"), ("common%rare", "are")]
    terms = spark.createDataFrame([(i, t) for i, t in enumerate(["common%rare", "co", "m", "_", "%", "x_", "", "é", "zz", "________________", "mmo"])], "term_pos int, term string")
    got = {}
    for r in search.search_keyword(rows, terms).collect():
        got[r["term"]] = got.get(r["term"], 0) + 1
    assert got == {"co": 60, "m": 60, "_": 60, "%": 60, "": 60, "mmo": 60}


def test_short_and_blank_terms_need_no_list_in_a_cell(spark):
    rows = spark.createDataFrame([("c", "ab", None, None), ("c", "", "", None), ("d", "b", "long text", None), (None, "ab", None, None)], "category string, name string, title string, description string")
    terms = spark.createDataFrame([(i, t) for i, t in enumerate(["b", "a_", "__", "___", "%", "_%_"])], "term_pos int, term string")
    out = search.match_substrings(rows, ["category", "name"], ["name", "title", "description"], terms.withColumn("lookup", F.lower("term")))
    got = {}
    for r in out.collect():
        got.setdefault(r["lookup"], []).append((r["category"], r["name"]))
    both = [("c", "ab"), (None, "ab"), ("d", "b")]
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in {
        "b": both, "a_": both[:2], "__": both, "_%_": both, "___": [("d", "b")], "%": [*both, ("c", "")]}.items()}
    assert "collect_list" not in out._jdf.queryExecution().executedPlan().toString()


def test_builds_are_compared_by_digests(spark):
    from fieldloom.operators import checks as C

    first = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"))
    assert C.differing_parts(first, first.select("v", "k")) == [] and C.content_difference(first, first.repartition(3)).count() == 0
    second = first.filter("k <> 17").unionByName(first.filter("k = 40")).unionByName(spark.createDataFrame([(-1, None)], "k long, v string"))
    got = sorted((r["k"], r["v"], r["only_in"]) for r in C.content_difference(first, second).collect())
    assert got == [(-1, None, "second"), (17, "17", "first"), (40, "40", "second")] and len(C.differing_parts(first, second)) <= 3
    agreed = C.content_difference(first, first.repartition(3))._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in agreed and "Range" not in agreed
    empty = first.limit(0)
    assert C.content_difference(empty, empty).count() == 0 and C.content_difference(empty, first.limit(2)).count() == 2
