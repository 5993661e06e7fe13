"""Work that grows with its input: what is gathered, sent or computed only once, on rows built here."""

from fieldloom.sources.loaders import typed_ranges
from fieldloom.sources.typemaps import VOCABULARY


def _plan(df, word):
    """Lines of the optimized plan that hold ``word``."""
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if word in line]


def test_labels_join_only_rows_that_show_them(spark):
    rows = spark.createDataFrame(
        [(1, ["x:a", "schema:C1", "schema:C2"]), (2, ["schema:C3"]), (3, ["schema:C1", "schema:Text"]), (4, ["schema:C9"]), (5, None), (6, []),
         (7, ["schema:C2"]), (7, ["schema:C2"]), (None, ["schema:C1"])],
        "doc_id int, ranges array<string>")
    enumerations = spark.createDataFrame([("schema:C1", '["a","b"]'), ("schema:C2", '["c"]'), ("schema:C3", None)], "range string, labels string")
    got = typed_ranges(rows, "doc_id", "ranges", VOCABULARY, enumerations)
    assert not [line for line in _plan(got, "Aggregate [doc_id") if "labels" in line]
    assert sorted((r[0] or 0, *r[1:]) for r in got.collect()) == [
        (0, "RELATION", None, "references C1"), (1, "VARCHAR", '["a","b"]', "enumeration C1"), (2, "VARCHAR", None, "enumeration C3"),
        (3, "VARCHAR", None, None), (4, "RELATION", None, "references C9"), (5, "RELATION", None, None), (6, "RELATION", None, None),
        (7, "VARCHAR", '["c"]', "enumeration C2"), (7, "VARCHAR", '["c"]', "enumeration C2")]


def test_rounds_of_the_closure_send_no_table_to_the_driver(spark, monkeypatch):
    from fieldloom.operators import graph

    plans, write = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, label))[1])
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 3), (5, 1), (6, 9)], "node bigint, parent bigint")
    got = graph.transitive_closure(edges, "node", "parent")
    assert plans and not [p for p in plans if "Broadcast" in p]
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3), (4, 1), (4, 2), (4, 3), (4, 4), (5, 1), (5, 2), (5, 3), (5, 5), (6, 6)]


def test_documents_are_parsed_once_and_without_their_schema(spark):
    from fieldloom.sources import documents as D

    texts = {1: '{"definitions":[]}', 2: '{"definitions":{}}', 3: '{"definitions":5}', 4: "{}", 5: "{", 6: None, 7: '{"definitions":null}', 8: "null"}
    docs = spark.createDataFrame(list(texts.items()), "id int, doc string")
    got = D.rejected_documents(docs, "doc", ["id"], "definitions")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("VariantExpressionEvalUtils.parseJson") <= 1 and "schema_of_variant" not in plan
    none = "no definitions"
    assert sorted(map(tuple, got.collect())) == [(3, none), (4, none), (5, "not JSON"), (6, "missing"), (7, none), (8, none)]


def test_members_are_read_once_from_each_document(spark):
    from fieldloom.sources import documents as D

    doc = ('{"definitions":["x",{"entityName":"E","hasAttributes":[{"attributeGroupReference":{"members":[{"name":"a","dataType":"integer","maximumLength":3},5,'
           '{"name":"b","dataType":{"dataTypeReference":"listLookup"}},{"name":"c"},{"name":"d","dataType":null},{"dataType":"date"}]}},{"other":1}]}]}')
    docs = spark.createDataFrame([(1, "E", doc), (2, "F", doc), (3, "E", None)], "id int, entity string, doc string")
    got = D.entity_attributes(docs, "doc", "entity", ["id", "entity"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json") + plan.count("JsonToStructs") <= 1 and "schema_of_variant" not in plan
    assert plan.count("attributeGroupReference.members") == 1
    assert sorted((r["attribute"], r["data_type"], r["byte_length"], r["is_option_set"]) for r in got.collect()) == [
        ("a", "INTEGER", 3, False), ("b", "INTEGER", None, True), ("d", "VARCHAR", None, False)]


def test_allowed_values_are_parsed_by_distinct_text(spark, items):
    from fieldloom.operators import harmonize as H

    rows = items(*[{"name": "e.a", "source_standard": "S" if i % 2 else "T", "allowed_values": '["b","a"]' if i % 3 else '["a"]'} for i in range(12)])
    facts = H._facts(rows, ["category", "name"], (H.SOURCE, H.VALUE))
    lines = facts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    parsed = max(n for n, line in enumerate(lines) if "json_array_length" in line or "lengthOfJsonArray" in line)
    assert "Aggregate" in "".join(lines[parsed:])          # it reads what an aggregate gives, not the items
    got = {(r["kind"], r["owner"], r["value"]): int(r["rank"]) for r in facts.collect()}
    at = lambda ord_, pos: ord_ * 2**31 + pos
    assert got == {("s", None, "T"): at(0, 0), ("s", None, "S"): at(1, 0), ("a", "T", '"a"'): at(0, 0), ("a", "T", '"b"'): at(2, 0),
                   ("a", "S", '"a"'): at(1, 1), ("a", "S", '"b"'): at(1, 0)}


def test_a_vocabulary_walks_around_its_classes_once(spark, monkeypatch):
    from fieldloom.operators import tours
    from fieldloom.sources.vocabulary import vocabulary_items

    walks, walk = [], tours.intervals
    monkeypatch.setattr(tours, "intervals", lambda tree: (walks.append(1), walk(tree))[1])
    doc = ('{"@graph":[{"@id":"schema:Enumeration","@type":"rdfs:Class"},{"@id":"schema:A","@type":"rdfs:Class"},'
           '{"@id":"schema:B","@type":"rdfs:Class","rdfs:subClassOf":[{"@id":"schema:A"},{"@id":"schema:Enumeration"}]},'
           '{"@id":"schema:p","@type":"rdf:Property","rdfs:label":"p","schema:domainIncludes":{"@id":"schema:A"},"schema:rangeIncludes":{"@id":"schema:B"}},'
           '{"@id":"schema:m","@type":"schema:B","rdfs:label":"M"}]}')
    docs = spark.createDataFrame([(doc,)], "doc string")
    targets = spark.createDataFrame([("B", "G"), ("Z", "G")], "type string, category string")
    got = vocabulary_items(docs, targets).select("name", "data_type", "allowed_values", "description").collect()
    assert list(map(tuple, got)) == [("B.p", "VARCHAR", '["M"]', "(enumeration B)")]
    assert len(walks) == 1
