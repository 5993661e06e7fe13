"""Row-level functions on hand-written cases."""

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import names as N
from fieldloom.functions import rules as U
from fieldloom.functions import values as V
from fieldloom.operators.enrich import override_descriptions
from fieldloom.operators.reports import coverage
from fieldloom.sources import speclines as S
from fieldloom.sources.markup import strip_markup


def values(spark, column, *rows, schema):
    df = spark.createDataFrame(list(enumerate(rows)) if not isinstance(rows[0], tuple) else [(i, *r) for i, r in enumerate(rows)],
                               "i int, " + schema)
    return [r[1] for r in df.select("i", column).orderBy("i").collect()]


def test_snake_case(spark):
    cases = {"GTINCode": "gtin_code", " a--B_ ": "a_b", "accountId": "account_id", "ID": "id", "Ship-To Name3": "ship_to_name3", "": ""}
    assert values(spark, N.snake_case(F.col("x")), *cases, schema="x string") == list(cases.values())


def test_snake_dotted(spark):
    cases = {
        "Account.accountId": "account.account_id", "MaterialLot.Quantity": "material_lot.quantity",
        "hr.employee.gender": "hr.employee.gender", "Quality Inspection.x": "quality_inspection.x",
        " _A . _b_ ._C_": "a.b.c", "a..b": "a..b", "plain Name": "plain_name",
    }
    assert values(spark, N.snake_dotted(F.col("x")), *cases, schema="x string") == list(cases.values())


def test_splits(spark):
    rows = ["hr.employee.gender", "solo"]
    assert values(spark, N.entity_of(F.col("x")), *rows, schema="x string") == ["hr.employee", "solo"]
    assert values(spark, N.entity_or_blank(F.col("x")), *rows, schema="x string") == ["hr.employee", ""]
    assert values(spark, N.field_of(F.col("x")), *rows, schema="x string") == ["gender", "solo"]
    assert values(spark, N.after_first_dot(F.col("x")), *rows, schema="x string") == ["employee.gender", "solo"]


def test_identifier_and_display_name(spark):
    assert values(spark, N.identifier(F.col("x")), "Stock.Picking--Type_", "é1", schema="x string") == ["stock_picking_type", "1"]
    shown = values(spark, N.humanize(F.col("x"), {"bom": "Bill of Materials"}), "bom", "stock.lot_A", schema="x string")
    assert shown == ["Bill of Materials", "Stock lot a"]


@pytest.mark.parametrize("cell, want", [
    (None, []), ("", []), ('["a","b","a"]', ['"a"', '"b"', '"a"']), ('[1,"1",true,null]', ["1", '"1"', "true", "null"]),
    ('{"S":["x","y"],"A":["z",3],"q":"[1]"}', ['"x"', '"y"', '"z"', "3", '"[1]"']), ('say "x"', ['"say \\"x\\""']), ("12", ["12"]), ("[]", []),
])
def test_parse_allowed_values(spark, cell, want):
    assert values(spark, V.parse_allowed_values(F.col("x")), (cell,), schema="x string") == [want]


def test_string_members(spark):
    rows = ['["a","b"]', "[]", '["a",1]', '{"s":["a"]}', "text", None]
    assert values(spark, V.string_members(F.col("x")), *rows, schema="x string") == [["a", "b"], None, None, None, None, None]


def test_relation_target(spark):
    rows = ["Party (links to Party.Party)", "X (REFERENCES  a, b)", "(references a,)", "none", None, "(collection of x)"]
    assert values(spark, U.relation_target(F.col("x")), *rows, schema="x string") == ["party_party", None, "a", None, None, None]
    assert values(spark, U.is_collection(F.col("x")), *rows, schema="x string") == [False] * 5 + [True]


def test_char_length(spark):
    rows = [("VARCHAR", 40, None), ("VARCHAR", 0, None), ("decimal", None, 2), ("DECIMAL", None, 0), ("BLOB", 1, None), (None, 7, None)]
    got = values(spark, U.char_length(F.col("t"), F.col("n"), F.col("s")), *rows, schema="t string, n int, s int")
    assert got == [40, 255, 20, 19, 8000, 255]


def test_validation_spec(spark):
    many = "[" + ",".join(f'"v{i}"' for i in range(13)) + "]"
    long = "[" + ",".join('"' + "x" * 40 + str(i) + '"' for i in range(6)) + "]"
    rows = [("DATE", "N6", None, None), ("VARCHAR", None, '["a","b"]', None), ("VARCHAR", "", many, None), ("VARCHAR", None, long, None),
            ("DECIMAL", None, None, 2), ("DECIMAL", None, None, None), ("FLOAT", None, None, None)]
    got = values(spark, U.validation_spec(F.col("t"), F.col("m"), F.col("a"), F.col("s"), F.lit(255)), *rows,
                 schema="t string, m string, a string, s int")
    assert got == ["N6", "one of: a|b", "one of: " + "|".join(f"v{i}" for i in range(12)) + "|…", "maxlength: 255",
                   r"^-?\d+(\.\d{1,2})?$", r"^-?\d+$", None]


def test_entity_bucket(spark):
    rows = ["gs1", "a.ask", "ask", "task.list", "a_b.c", "a.b_c", "plain"]
    assert values(spark, U.entity_bucket(F.col("x")), *rows, schema="x string") == [
        "catalog", "noise", "noise", "entity", "noise", "entity", "entity"]


def test_ui_field_name(spark):
    rows = [("a.b.c", "a.b"), ("a.ask.x", "Wizard"), ("other.x", "a")]
    assert values(spark, U.ui_field_name(F.col("n"), F.col("g")), *rows, schema="n string, g string") == ["c", "a.ask.x", "x"]


def test_enum_check(spark):
    rows = ['["a","it\'s"]', '["' + "x" * 200 + '"]', "[1]", None]
    assert values(spark, U.enum_check(F.lit("c"), F.col("x")), *rows, schema="x string") == [
        "CHECK (c IN ('a', 'it''s'))", None, None, None]


def test_dialect_type(spark):
    row = ("VARCHAR", 70000, None)
    for dialect, kind, want in [("sqlite", row, "VARCHAR(255)"), ("mysql", ("OBJECT", None, None), "JSON"),
                                ("postgres", ("DECIMAL", None, 4), "DECIMAL(18,4)"), ("postgres", ("OTHER", None, None), "TEXT")]:
        got = values(spark, U.dialect_type(dialect, F.col("t"), F.col("n"), F.col("s"), F.lit(False)), kind, schema="t string, n int, s int")
        assert got == [want]


def test_synthesize_description(spark):
    av = "[" + ",".join(f'"{i:02}"' for i in range(14)) + "]"
    rows = [("stock.lot.name", "Lot", av), ("stock.lot.ref", "", None), ("x.y", None, '["a","a",""]')]
    got = values(spark, U.synthesize_description(F.col("n"), F.col("t"), F.col("a")), *rows, schema="n string, t string, a string")
    shown = ", ".join(f"{i:02}" for i in range(12))
    assert got == [f"Stock lot: Lot. Allowed values: {shown}, ... (+2 more).", "Stock lot: ref.", "X: y. Allowed values: a."]


def test_coverage_grade(spark):
    rows = [100.0, 99.9, 90.0, 75.0, 50.0, 49.9]
    assert values(spark, U.coverage_grade(F.col("x")), *rows, schema="x double") == [
        "brightgreen", "green", "green", "yellowgreen", "yellow", "orange"]


def test_strip_markup(spark):
    rows = ["<b>a</b>  <i>b</i>\n", "<br>", None, "x < y"]
    assert values(spark, strip_markup(F.col("x")), *rows, schema="x string") == ["a b", None, None, "x < y"]


def test_spec_lines(spark):
    text = ["01  *?  N14,csum,pos2   ex=255,37 dlpkey=22,10   # GTIN", "  # comment", "no title N3", "3100-3105 N6 # WEIGHT (kg)",
            "7003  N6,yymmdd N4,hhmi # EXPIRY TIME", "91 X..90 # INTERNAL", "17 *? dlpkey # NO SPEC", "3910 N3,iso4217 N..15 # PRICE",
            "8001 [X5] N..2 # ROLL", "20 N2 # GTIN", "21 #  "]
    df = spark.createDataFrame(list(enumerate(text)), "ord bigint, line string")
    rows = S.parse_lines(df)
    c, s = F.col("code"), F.col("spec")
    out = S.unique_names(rows).select("ord", "code", "spec", "title", S.spec_type(c, s), S.spec_length(s), S.code_category(c), "name")
    assert [tuple(r) for r in out.orderBy("ord").collect()] == [
        (0, "01", "N14,csum,pos2", "GTIN", "VARCHAR", 14, S.PRODUCT, "gs1.gtin"),
        (3, "3100-3105", "N6", "WEIGHT (kg)", "DECIMAL", 6, S.PRODUCT, "gs1.weight_kg"),
        (4, "7003", "N6,yymmdd N4,hhmi", "EXPIRY TIME", "DATETIME", 6, S.INVENTORY, "gs1.expiry_time"),
        (7, "3910", "N3,iso4217 N..15", "PRICE", "DECIMAL", 15, S.FINANCE, "gs1.price"),
        (8, "8001", "[X5] N..2", "ROLL", "VARCHAR", 5, S.PRODUCT, "gs1.roll"),
        (9, "20", "N2", "GTIN", "VARCHAR", 2, S.PRODUCT, "gs1.gtin_20"),
    ]


def test_names_taken_by_a_suffixed_name(spark):
    rows = [(0, "01", "A"), (1, "02", "A"), (2, "03", "A 02"), (3, "04", "A 02 03"), (4, "05", "B 05"), (5, "06", "B")]
    df = spark.createDataFrame(rows, "ord bigint, code string, title string")
    got = [r["name"] for r in S.unique_names(df, "").orderBy("ord").collect()]
    seen, want = set(), []
    for _, code, title in rows:
        slug = title.lower().replace(" ", "_")
        want.append(f"{slug}_{code}" if slug in seen else slug)
        seen.add(want[-1])
    assert got == want == ["a", "a_02", "a_02_03", "a_02_03_04", "b_05", "b"]


def test_target_of_signs_only_is_none(spark):
    df = spark.createDataFrame([("(references ---)",), ("(references A-b)",)], "d string")
    assert [r[0] for r in df.select(U.relation_target(F.col("d"))).collect()] == [None, "a_b"]


def test_a_name_with_two_texts_counts_once(spark):
    curated = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", None)], "name string, description string")
    rows = spark.createDataFrame([("C", "a", "b"), ("C", "c", None)], "category string, name string, description string")
    assert sorted((r["name"], r["description"]) for r in override_descriptions(rows, curated).collect()) == [("a", "b"), ("c", None)]
    assert [(r["items"], r["curated"]) for r in coverage(rows, curated).filter("category = 'C'").collect()] == [(2, 1)]


def test_names_with_nothing_to_trim_take_no_trimming(spark):
    """Both ways give one result; a plain name meets two patterns and a test instead of five patterns."""
    names = ["Order12.partKey5", "GTINCode", "a.B.cD", ".aB", "aB.", "..", "", "ABc.DEf", "x9Y.z", "Ship-To Name", "_a.B_", "a_B.c", " a . B ", "éA.bÉ", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.x for r in df.select("n", N.snake_dotted(F.col("n")).alias("x")).collect()}
    same = {r.n: r.x for r in df.select("n", F.substring(N.snake_dotted(F.concat(F.col("n"), F.lit(". "))), 1, 99).alias("x")).collect()}
    assert {n: x if x is None else x + "." for n, x in got.items()} == same
    assert got["Order12.partKey5"] == "order12.part_key5" and got["ABc.DEf"] == "a_bc.d_ef" and got["Ship-To Name"] == "ship_to_name"
    whole = df.select(N.snake_dotted(F.col("n")))._jdf.queryExecution().optimizedPlan().toString()
    assert whole.startswith("Project [CASE WHEN RLIKE(")
