"""Declarations in program texts; scripts of a selection."""

import pytest

from fieldloom.operators import schema
from fieldloom.operators.harmonize import merge_items
from fieldloom.sources import blocks as B

KINDS = {"Char": "VARCHAR", "Selection": "VARCHAR", "Many2one": "RELATION", "Float": "DECIMAL"}


def fields(spark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return sorted(tuple(r) for r in B.declared_fields(docs, ["id"], "text", KINDS).collect())


def options(spark, text):
    docs = spark.createDataFrame([(0, text)], "id int, text string")
    return sorted((r.name, r.option, r.code, r.label) for r in B.declared_options(B.tokens(docs, ["id"], "text"), ["id"], ["selection"]).collect())


def test_titles_targets_and_flags(spark):
    got = fields(spark, '''
class A:  # (not a bracket
    _name = "a.b"
    a = fields.Char("First, (really)", required=True)
    b = fields.Char(size=3, string='It\\'s')
    c = Many2one('res.partner', 'Partner', domain=[('x', '=', 'y')])
    d = fields.Float(digits=(16, 2), compute="_f")
    e = fields.Char()
    f = unknown.Thing("x")
    g = fields.Many2one(comodel)
''')
    assert [g[2:8] for g in got] == [
        ("a", "Char", "VARCHAR", "First, (really)", None, True), ("b", "Char", "VARCHAR", "It's", None, False), ("c", "Many2one", "RELATION", "Partner", "res.partner", False),
        ("d", "Float", "DECIMAL", "d", None, False), ("e", "Char", "VARCHAR", "e", None, False), ("g", "Many2one", "RELATION", "g", None, False)]
    assert [g[1] for g in got] == [0, 1, 2, 3, 4, 6]


def test_nested_options_become_rows(spark):
    text = """s = fields.Selection([('a', 'A (x)'), ('b, c', "B]"), 'lone', ('d', _('D'))], 'State')
t = fields.Selection(string="T", selection=[("x", "X")])
u = fields.Selection(other, extra=[('no', 'No')])"""
    assert options(spark, text) == [("s", 0, "a", "A (x)"), ("s", 1, "b, c", "B]"), ("s", 2, "lone", "lone"), ("s", 3, "d", "D"), ("t", 0, "x", "X")]
    assert [(g[2], g[5], g[8]) for g in fields(spark, text)] == [("s", "State", '["a","b, c","lone","d"]'), ("t", "T", '["x"]'), ("u", "u", None)]


@pytest.mark.parametrize(("text", "names"), [
    ("a = Char('x')\nb = Char('y'", ["a"]), ("a = Char('x'))\nb = Char('y')", ["a"]), (")a = Char('x')", []), ("a = Char(('x')\nb = Char('y')", []),
    ("x = [1, (2)]\na = Char('x')\ny = f(1)\nb = Char()", ["a", "b"]), ("", []), (None, []), ("a = Char('unclosed string)", ["a"]), ("call(a = Char('x'))", []), ("#a = Char('x')", [])])
def test_unbalanced_and_odd_texts(spark, text, names):
    assert [g[2] for g in fields(spark, text)] == names


def test_texts_do_not_mix(spark):
    assert [(g[0], g[2]) for g in fields(spark, "a = Char(", "b = Char()", ")", "c = Char()")] == [(1, "b"), (3, "c")]


def test_script_of_a_selection_names_parents_outside(spark, items):
    cat = merge_items(items(
        dict(name="invoice.total", data_type="DECIMAL"), dict(name="invoice.order", data_type="RELATION", description="x (links to Order)"),
        dict(name="invoice.customer", data_type="RELATION", description="y (links to Customer)"), dict(name="order.id", data_type="INTEGER"), dict(name="customer.id", data_type="INTEGER")))
    hits = spark.createDataFrame([(2, "C", "order.id"), (1, "C", "invoice.total"), (1, "C", "invoice.order"), (2, "C", "invoice.order"), (1, "C", "invoice.customer")], "term_pos int, category string, name string")
    terms = spark.createDataFrame([(2, "order"), (1, "invoice")], "term_pos int, term string")
    picked = schema.selected_items(cat, hits)
    assert sorted(r.name for r in picked.collect()) == ["invoice.customer", "invoice.order", "invoice.total", "order.id"]
    lines = schema.script_lines(picked, terms, ("sqlite", "postgres", "mysql"))
    rows = sorted(tuple(r) for r in lines.collect())
    sqlite = [r[5] for r in rows if r[0] == "sqlite"]
    assert sqlite[:4] == ["-- dialect: sqlite", "-- terms: invoice, order", "-- 2 tables, 4 items", "PRAGMA foreign_keys = ON;"]
    assert any("FOREIGN KEY" in x and "REFERENCES order(" in x for x in sqlite) and any("external ref: y (links to Customer)" in x for x in sqlite)
    assert not any("REFERENCES customer" in x for x in sqlite)
    assert [r[5] for r in rows if r[0] == "postgres"][3].startswith("-- order") and [r[5] for r in rows if r[0] == "mysql"][3] == "SET FOREIGN_KEY_CHECKS = 1;"
    assert schema.script_lines(picked.limit(0), terms, ("sqlite",)).count() == 0
