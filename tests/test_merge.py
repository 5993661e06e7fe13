"""Survivorship rules on small groups."""

import json

from fieldloom.operators import harmonize as H
from fieldloom.operators.enrich import backfill_descriptions, override_descriptions, unmatched_overrides


def merged(df):
    return {(r["category"], r["name"]): r for r in H.merge_items(df).collect()}


def one(df):
    (row,) = merged(df).values()
    return row


def test_lone_item_is_untouched(items):
    r = one(items(dict(name="a.b", title="", description="", is_nullable=True, is_required=True, allowed_values="x", source_standard="S")))
    assert (r["title"], r["description"], r["is_required"], r["is_nullable"], r["allowed_values"]) == ("", "", True, True, "x")
    r = one(items(dict(name="a.b")))
    assert (r["is_required"], r["is_nullable"], r["n_members"], r["n_sources"]) == (False, True, 1, 1)


def test_first_of_equals_is_primary(items):
    r = one(items(dict(name="n", data_type="TEXT", title="one", source_standard="B"), dict(name="n", data_type="DATE", title="two", source_standard="A")))
    assert (r["data_type"], r["title"], r["source_standard"]) == ("TEXT", "one", "B; A")


def test_primary_supplies_even_missing_columns(items):
    r = one(items(dict(name="n", format_mask="M", decimal_scale=3, title="t"), dict(name="n", description="d", title="u")))
    assert (r["format_mask"], r["decimal_scale"], r["title"], r["description"]) == (None, None, "u", "d")


def test_description_and_title_fallbacks(items):
    r = one(items(dict(name="n", description="ab", title="", data_type="TEXT", byte_length=1), dict(name="n", description="cd", title="x"),
                  dict(name="n", description="", title="y")))
    assert (r["description"], r["title"]) == ("ab", "x")
    assert one(items(dict(name="n", description=""), dict(name="n")))["description"] is None


def test_required_and_length(items):
    r = one(items(dict(name="n", is_required=False, byte_length=4), dict(name="n", is_required=True), dict(name="n", byte_length=9)))
    assert (r["is_required"], r["is_nullable"], r["byte_length"]) == (True, False, 9)


def test_provenance_order_and_blanks(items):
    r = one(items(dict(name="n", source_standard="Z", source_url="u2", version=""), dict(name="n", source_standard="A", source_url="u1"),
                  dict(name="n", source_standard=None, source_url="u2")))
    assert (r["source_standard"], r["source_url"], r["version"], r["n_sources"]) == ("Z; A", "u2 | u1", None, 3)


def values(items, *cells):
    return one(items(*[dict(name="n", source_standard=s, allowed_values=v) for s, v in cells]))["allowed_values"]


def test_allowed_values_none(items):
    assert values(items, ("A", None), ("B", "")) is None


def test_allowed_values_one_source_is_a_flat_union(items):
    assert json.loads(values(items, ("A", '["b","a"]'), ("A", '["c","a",1]'), ("B", None))) == ["b", "a", "c", 1]


def test_allowed_values_equal_sets_stay_flat(items):
    assert json.loads(values(items, ("B", '["y","x"]'), ("A", '["x","y"]'))) == ["y", "x"]


def test_allowed_values_diverge_by_source(items):
    text = values(items, ("Z", '["y","x"]'), (None, '{"q":["k"],"r":7}'), ("A", "plain"), ("A", '["x"]'))
    assert text == '{"A":["plain","x"],"Z":["y","x"],"unknown":["k",7]}'


def test_names_meet_through_aliases(items):
    raw = items(dict(name="account.invoice.partyId", source_standard="T"), dict(name="Invoice.PartyID", source_standard="C"),
                dict(name="gs1.gtin", source_standard="G"), dict(name="Product.GTIN", source_standard="S"))
    norm = H.normalize_items(raw, {"account.invoice": "invoice"}, {"gs1.gtin": "product.gtin"})
    assert {k[1]: r["source_standard"] for k, r in merged(norm).items()} == {"invoice.party_id": "T; C", "product.gtin": "G; S"}
    report = {(r["name"], r["sources"], r["count"]) for r in H.merge_report(norm).collect()}
    assert report == {("invoice.party_id", "T; C", 2), ("product.gtin", "G; S", 2)}


def test_related_concepts_count_single_sources(items):
    raw = items(dict(name="a.f", source_standard="S"), dict(name="b.f", source_standard="T"), dict(name="a.g", source_standard="S"),
                dict(name="b.g", source_standard="S"), dict(name="c.h", source_standard="S"), dict(name="c.h", source_standard="T"),
                dict(name="f", source_standard="S"))
    rows = [tuple(r) for r in H.related_concepts(H.merge_items(raw)).collect()]
    assert rows == [("C", "f", ", a, b", "S, T")]


def test_hot_key_keeps_every_distinct_value(spark):
    """A third of all rows under one key: same rules, nothing dropped."""
    df = H.conform(spark.range(30000).selectExpr(
        "id AS ord", "'C' AS category", "CASE WHEN id % 3 = 0 THEN 'hot.f' ELSE concat('e.f', id) END AS name",
        "concat('S', id % 7) AS source_standard", "concat('u', id % 1000) AS source_url", "concat('[\"', id % 50, '\"]') AS allowed_values"))
    r = merged(df.repartition(8))[("C", "hot.f")]
    assert r["n_members"] == 10000 and r["n_sources"] == 7
    assert r["source_url"].split(" | ") == [f"u{(3 * i) % 1000}" for i in range(1000)]
    assert sorted(map(int, json.loads(r["allowed_values"]))) == list(range(50))


def test_overrides_and_backfill(spark, items):
    cat = H.merge_items(items(dict(name="a.x", description="old"), dict(name="a.y", description="same"), dict(name="a.z", title="Zed")))
    curated = spark.createDataFrame([("a.x", "new"), ("a.y", "same"), ("gone", "t")], "name string, description string")
    once = override_descriptions(cat, curated)
    assert {r["name"]: (r["description"], r["changed"]) for r in once.collect()} == {
        "a.x": ("new", True), "a.y": ("same", False), "a.z": (None, False)}
    assert override_descriptions(once.drop("changed"), curated).filter("changed").count() == 0
    assert [r["name"] for r in unmatched_overrides(cat, curated).collect()] == ["gone"]
    filled = backfill_descriptions(cat, {}).filter("name = 'a.z'").head()["description"]
    assert filled == "A: Zed."
    assert backfill_descriptions(cat, {}, category="other").filter("name = 'a.z'").head()["description"] is None


def test_item_ids_are_stable(items):
    cat = H.with_item_id(H.merge_items(items(dict(name="a"), dict(name="b"), dict(name="a", category="D"))))
    first, again = ({(r["category"], r["name"]): r["item_id"] for r in cat.collect()} for _ in range(2))
    assert first == again and len(set(first.values())) == 3


def test_both_ways_to_merge_agree(items):
    raw = items(dict(name="a", source_standard="S", source_url="u"), dict(name="a", source_standard="T", allowed_values='["x"]'),
                dict(name="b", description="", allowed_values="y", source_standard=None), dict(name="c", title="t", source_standard=""))
    for key in (None, [*H.KEY, "source_standard"]):
        first, second = H.merge_items(raw, key), H.merge_items(raw, key, preselect=False)
        assert first.count() > 0 and first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
    by_source = {(r["name"], r["source_standard"]) for r in H.merge_items(raw, [*H.KEY, "source_standard"]).collect()}
    assert by_source == {("a", "S"), ("a", "T"), ("b", None), ("c", "")}


def test_divergent_values_are_keyed_by_plain_names(items):
    """A quote sorts after a blank, so sorting the quoted names would put the longer one first."""
    rows = items(
        {"name": "a", "source_standard": "Odoo 17", "allowed_values": '["x"]'}, {"name": "a", "source_standard": "Odoo", "allowed_values": '["y"]'},
        {"name": "a", "source_standard": 'Odoo"', "allowed_values": '["z"]'})
    assert H.merge_items(rows).first()["allowed_values"] == '{"Odoo":["y"],"Odoo 17":["x"],"Odoo\\"":["z"]}'


def test_missing_and_blank_keys_merge_with_their_sources(items):
    rows = items(
        {"category": None, "name": "a", "source_standard": "S"}, {"category": None, "name": "a", "source_standard": "T"},
        {"category": "", "name": "a", "source_standard": "U"}, {"category": "C", "name": None, "source_standard": "V"}, {"category": "C", "name": None, "source_standard": "W"})
    for preselect in (True, False):
        got = {(r["category"], r["name"]): (r["n_members"], r["n_sources"], r["source_standard"]) for r in H.merge_items(rows, preselect=preselect).collect()}
        assert got == {(None, "a"): (2, 2, "S; T"), ("", "a"): (1, 1, "U"), ("C", None): (2, 2, "V; W")}


def test_missing_categories_are_keys_in_every_report(items):
    rows = items(*[dict(name="a.b", category=c, source_standard=s, allowed_values='["x"]') for c in (None, "c") for s in ("S1", "S2")])
    norm = H.normalize_items(rows, {}, {})
    assert sorted((str(r["category"]), r["sources"], r["count"]) for r in H.merge_report(norm).collect()) == [("None", "S1; S2", 2), ("c", "S1; S2", 2)]
    merging = H.only_merging(norm, H.KEY)
    assert merging.count() == 4 and merging.columns == norm.columns
    facts = H.join_by_key(merging.groupBy(*H.KEY).count(), H.collect_facts(merging, H.KEY, (H.SOURCE,)), H.KEY, "left")
    assert all(len(r["facts"]) == 2 for r in facts.collect())
