"""Line-oriented code specifications: ``<code> [flags] <spec> [attributes] # TITLE``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..literals import literal_table
from ..operators.ranges import match_ranges
from ..storage import materialize

SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
# A length component of a spec, and the category names.
COMPONENT = r"\[?([NXYZ])(\.\.)?(\d+)"
ASSETS, CRM, FINANCE = "Maintenance / Asset Management", "Customer Relationship Management (CRM)", "Finance / Accounting"
INVENTORY, PRODUCT, LOGISTICS = "Inventory / Warehouse", "Product Master Data", "Supply Chain / Logistics"

# Ordered rules (category, codes, numeric ranges); the first that applies wins.
CATEGORY_RULES = [
    (ASSETS, ["8003", "8004", "7023"], []),
    (CRM, ["8017", "8018"], []),
    (FINANCE, ["415", "8020", "8005", "8008"], [(3900, 3999)]),
    (INVENTORY, ["10", "21", "22", "235", "250", "251", "254", "30", "37", "7003", "7006", "7007", "7011",
                 "11", "12", "13", "14", "15", "16", "17"], []),
    (PRODUCT, ["01", "02", "03", "20", "240", "241", "242", "243", "7001", "7002", "7004", "7005", "7008", "7009",
               "7010", "7020", "7021", "7022", "8001", "8002", "8006", "8007", "8013", "8019", "8026", "8200"],
     [(710, 716), (3100, 3699)]),
]
DEFAULT_CATEGORY = LOGISTICS
# Codes left to mutual agreement.
INTERNAL_CODES = ["90", "91", "92", "93", "94", "95", "96", "97", "98", "99"]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def base_code(code: Column) -> Column:
    """Code of a range: the part before the hyphen."""
    return F.substring_index(code, "-", 1)


def code_number(code: Column) -> Column:
    digits = F.regexp_replace(base_code(code), "[^0-9]", "")
    return F.coalesce(digits.try_cast("bigint"), F.lit(-1))


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """``code``, ``spec`` and ``title`` of every definition line."""
    text = F.col(line)
    rows = lines.filter(F.contains(text, F.lit("#")) & ~F.rlike(text, F.lit(f"^{SPACE}*#")))
    tokens = F.filter(F.split(F.substring_index(text, "#", 1), f"{SPACE}+"), lambda t: t != "")
    title = strip(F.substr(text, F.instr(text, "#") + 1))
    rows = rows.withColumn("tokens", tokens).withColumn("title", title).filter(F.size("tokens") > 0)
    flagged = F.coalesce(F.rlike(F.try_element_at("tokens", F.lit(2)), F.lit(r"^[*?]+$")), F.lit(False))
    first = F.when(flagged, 3).otherwise(2)
    rest = F.slice("tokens", first, F.size("tokens"))
    # Tokens before the first attribute; position 0 means that there is none.
    cut = F.array_position(F.transform(rest, lambda t: F.contains(t, F.lit("=")) | (t == "dlpkey")), True)
    spec = F.slice(rest, F.lit(1), F.when(cut > 0, cut.cast("int") - 1).otherwise(F.size(rest)))
    rows = rows.withColumn("code", F.try_element_at("tokens", F.lit(1))).withColumn("spec", F.array_join(spec, " ")).drop("tokens", line)
    return rows.filter((F.col("spec") != "") & ~base_code(F.col("code")).isin(INTERNAL_CODES))


def spec_type(code: Column, spec: Column) -> Column:
    """Date, time and decimal kinds from the mask and the numeric code range."""
    low, n = F.lower(spec), code_number(code)
    is_date = F.contains(low, F.lit("yymmd"))
    is_time = F.contains(low, F.lit("hhmi")) | F.contains(low, F.lit("hhmm"))
    return (F.when(is_date & is_time, "DATETIME").when(is_date, "DATE")
            .when(n.between(3100, 3699) | n.between(3900, 3949), "DECIMAL").otherwise("VARCHAR"))


def spec_length(spec: Column) -> Column:
    """Largest component length, when the spec starts with a component."""
    sizes = F.transform(F.regexp_extract_all(spec, F.lit(COMPONENT), F.lit(3)), lambda n: n.try_cast("int"))
    return F.when(F.rlike(spec, F.lit("^" + COMPONENT)), F.array_max(sizes))


def code_category(code: Column) -> Column:
    """Category by the ordered rules, as one conditional expression."""
    out, base, n = None, base_code(code), code_number(code)
    for category, codes, ranges in CATEGORY_RULES:
        hit = base.isin(codes)
        for low, high in ranges:
            hit = hit | n.between(low, high)
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out.otherwise(DEFAULT_CATEGORY)


def category_table(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The ordered rules as tables: single codes (code, category, priority) and ranges (lo, hi, category, priority)."""
    codes = [(c, category, i) for i, (category, listed, _) in enumerate(CATEGORY_RULES) for c in listed]
    ranges = [(lo, hi, category, i) for i, (category, _, listed) in enumerate(CATEGORY_RULES) for lo, hi in listed]
    return literal_table(spark, ["code", "category", "priority"], codes), literal_table(spark, ["lo", "hi", "category", "priority"], ranges)


def categorize(rows: DataFrame, codes: DataFrame, ranges: DataFrame, default: str, code: str = "code") -> DataFrame:
    """``rows`` with the category of the rule of least priority that holds their code; rules are tables of any size.

    Rules are found for the distinct codes only: single codes by equality, ranges by
    ``match_ranges``. Of rules with equal priority the first name wins.
    """
    distinct = rows.select(F.col(code).alias("__code")).distinct()
    keyed = distinct.select("__code", base_code(F.col("__code")).alias("__base"), code_number(F.col("__code")).alias("__n"))
    single = keyed.join(codes.withColumnRenamed("code", "__base"), "__base").select("__code", "priority", "category")
    within = match_ranges(keyed, "__n", ranges).select("__code", "priority", "category")
    best = single.unionByName(within).groupBy("__code").agg(F.min(F.struct("priority", "category"))["category"].alias("category"))
    return rows.join(best.withColumnRenamed("__code", code), code, "left").withColumn("category", F.coalesce("category", F.lit(default)))


def title_slug(title: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(slug == "", "ai").otherwise(slug)


def unique_names(rows: DataFrame, prefix: str = "gs1.") -> DataFrame:
    """Name from the title; a line whose name is already taken adds its code.

    The first line per slug comes from a partial aggregation that is joined back,
    not from a window that would sort a frequent title in one task.  A first line
    can still find its slug taken by an earlier suffixed name; those few lines are
    looked up until no further one turns up.
    """
    rows = rows.withColumn("slug", title_slug(F.col("title")))
    suffixed = F.concat_ws("_", "slug", F.translate("code", "-", "_"))
    first = rows.groupBy("slug").agg(F.min(F.struct("ord", "code")).alias("f")).select(
        "slug", F.col("f.ord").alias("first_ord"), F.col("f.code").alias("code"))
    first = materialize(first, "slugs")
    heads = first.select("slug", "first_ord")
    late = rows.join(heads, "slug").filter("ord > first_ord")
    taken = late.select(suffixed.alias("slug"), "ord").groupBy("slug").agg(F.min("ord").alias("ord"))
    renamed = None
    while True:
        hit = first.join(taken, "slug").filter("ord < first_ord")
        if renamed is not None:
            hit = hit.join(renamed, "slug", "left_anti")
        hit = materialize(hit.select("slug", "first_ord", "code"), "taken")
        if hit.isEmpty():
            break
        renamed = hit.select("slug") if renamed is None else renamed.unionByName(hit.select("slug"))
        taken = hit.select(suffixed.alias("slug"), F.col("first_ord").alias("ord")).groupBy("slug").agg(F.min("ord").alias("ord"))
    if renamed is not None:
        heads = heads.join(renamed, "slug", "left_anti")
    heads = heads.withColumnRenamed("first_ord", "ord").withColumn("plain", F.lit(True))
    named = rows.join(heads, ["slug", "ord"], "left")
    return named.withColumn("name", F.concat(F.lit(prefix), F.when(F.col("plain"), F.col("slug")).otherwise(suffixed))).drop("slug", "plain")


def describe(code: Column, title: Column, spec: Column) -> Column:
    text = F.concat(F.lit("GS1 Application Identifier ("), code, F.lit(") - "), title, F.lit(". GS1 format: "), spec, F.lit("."))
    decimals = (spec_type(code, spec) == "DECIMAL") & (
        F.substring(code, 1, 3).between("310", "369") | (F.substring(code, 1, 2) == "39"))
    return F.concat(text, F.when(decimals, " The last AI digit indicates the number of implied decimal places.").otherwise(""))
