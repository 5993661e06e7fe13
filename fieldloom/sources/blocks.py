"""Declarations out of program texts, brackets and all, without a parser.

``name = kind(argument, keyword=argument, ...)``: a text is cut into tokens by one
pattern; strings, in which brackets mean nothing, are single tokens. How deep a
token lies is a running sum over the brackets before it. A declaration starts where
a name, an equals sign and a kind stand in front of a bracket that nothing encloses;
what follows belongs to it until the depth is back at zero. Commas one level deep
count its arguments, commas two levels deep the members of a list. All of these are
running sums over one order.

Kinds of brackets are not told apart. A text whose brackets do not match is read as
far as that holds: after a bracket that closes nothing, no token counts, and a
declaration that is never closed gives no row. A quote without a partner is no token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Strings, names, numbers, brackets and signs; comments are tokens that are dropped.
TOKEN = r"""(#[^\n]*|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[A-Za-z_][A-Za-z0-9_.]*|[0-9]+(?:\.[0-9]+)?|[\[\](){},=])"""
OPENING, CLOSING = ["(", "[", "{"], [")", "]", "}"]
NAME = r"^[A-Za-z_]"


def _string(token: Column) -> Column:
    """The text of a string token, NULL for others."""
    inner = F.regexp_replace(F.substr(token, F.lit(2), F.length(token) - 2), r"\\(.)", "$1")
    return F.when(F.rlike(token, F.lit("""^['"]""")), inner)


def tokens(docs: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, i, token, depth, start, block, argument, member, name, kind) of all declarations: their first bracket, and the tokens inside."""
    rows = docs.select(*key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(1))).alias("i", "token"))
    rows = rows.filter(~F.startswith("token", F.lit("#")))
    order = W.partitionBy(*key).orderBy("i")
    before, so_far = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, W.currentRow)
    token = F.col("token")
    step = F.when(token.isin(OPENING), 1).when(token.isin(CLOSING), -1).otherwise(0)
    back = lambda n: F.lag("token", n).over(order)
    rows = rows.withColumn("depth", F.coalesce(F.sum(step).over(before), F.lit(0)))
    start = (F.col("depth") == 0) & (token == "(") & F.rlike(back(1), F.lit(NAME)) & (back(2) == "=") & F.rlike(back(3), F.lit(NAME))
    rows = rows.withColumns({"lowest": F.min(F.col("depth") + step).over(so_far), "start": F.coalesce(start, F.lit(False)), "kind": back(1), "name": back(3)})
    rows = rows.filter("lowest >= 0").withColumn("block", F.sum(F.col("start").cast("int")).over(so_far))
    # a run of tokens that starts outside of all brackets and not at a declaration is no part of one
    outside = (F.col("depth") == 0) & ~F.col("start") & token.isin(OPENING)
    rows = rows.withColumn("strays", F.sum(outside.cast("int")).over(so_far))
    inside = W.partitionBy(*key, "block").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    comma = lambda depth: F.sum((F.col("depth").eqNullSafe(F.lit(depth)) & (F.col("token") == ",")).cast("int")).over(inside)
    whole = W.partitionBy(*key, "block")
    rows = rows.filter("block > 0").withColumns({
        "argument": comma(1), "member": comma(2),
        "name": F.first(F.when(F.col("start"), F.col("name")), True).over(whole), "kind": F.first(F.when(F.col("start"), F.col("kind")), True).over(whole),
        "first_strays": F.min("strays").over(whole), "closed": F.max((token.isin(CLOSING) & (F.col("depth") == 1)).cast("int")).over(whole)})
    within = (F.col("depth") > 0) & (F.col("strays") == F.col("first_strays")) & ~((F.col("depth") == 1) & token.isin(CLOSING))
    rows = rows.filter((F.col("closed") == 1) & (F.col("start") | within))
    return rows.drop("lowest", "strays", "first_strays", "closed")


def _arguments(found: DataFrame, key: list[str]) -> DataFrame:
    """(key, block, argument, keyword, value): each argument with its keyword, if it has one, and its value if that is one token."""
    at = F.struct("i", "token")
    direct = F.when(F.col("depth") == 1, at)
    grouped = found.filter("NOT start AND token <> ','").groupBy(*key, "block", "argument").agg(
        F.array_sort(F.collect_list(direct)).alias("direct"), F.count("*").alias("n"))
    named = F.coalesce(F.try_element_at("direct", F.lit(2))["token"] == "=", F.lit(False))
    value = F.when(named, F.try_element_at("direct", F.lit(3))["token"]).otherwise(F.try_element_at("direct", F.lit(1))["token"])
    return grouped.select(*key, "block", "argument", F.when(named, F.try_element_at("direct", F.lit(1))["token"]).alias("keyword"),
                          F.when(F.col("n") == F.when(named, 3).otherwise(1), value).alias("value"))


def declared_options(found: DataFrame, key: list[str], keywords: list[str]) -> DataFrame:
    """(key, block, name, option, code, label): members of the list that is the first argument or that of one of ``keywords``.

    A member that is a pair gives code and label, a lone string both.
    """
    arguments = _arguments(found, key).filter((F.col("argument") == 0) & F.col("keyword").isNull() | F.col("keyword").isin(keywords)).select(*key, "block", "argument")
    strings = found.withColumn("s", _string(F.col("token"))).filter(F.col("s").isNotNull() & (F.col("depth") > 1))
    rows = strings.join(arguments, [*key, "block", "argument"], "left_semi")
    # commas between members are two levels deep, those inside of a pair deeper
    pairs = rows.groupBy(*key, "block", "name", "argument", "member").agg(F.min(F.struct("i", "s"))["s"].alias("code"), F.max(F.struct("i", "s"))["s"].alias("label"), F.min("i").alias("at"))
    first = pairs.groupBy(*key, "block", "argument").agg(F.min("member").alias("low"))
    return pairs.join(first, [*key, "block", "argument"]).select(
        *key, "block", "name", (F.col("member") - F.col("low")).cast("int").alias("option"), "code", "label")


def declared_fields(docs: DataFrame, key: list[str], text: str, kinds: dict[str, str], label: str = "string", options: tuple[str, ...] = ("selection",),
                    relations: tuple[str, ...] = ("RELATION",)) -> DataFrame:
    """Fields declared in program texts: (key, position, name, kind, data_type, title, target, is_required, allowed_values).

    ``kinds`` maps the last part of a kind to a logical type; other declarations are left out. The
    title is the keyword ``label``, else the first argument that is a string without keyword (of a relation
    the first after its target), else the name. A relation's target is its first argument. Allowed values are the codes of the
    option list. Null texts give nothing; a text whose brackets do not match is read up to there.
    """
    found = tokens(docs, key, text)
    arguments = _arguments(found, key)
    own = F.substring_index("kind", ".", -1)
    logical = F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), own)
    value = _string(F.col("value"))
    positional = F.col("keyword").isNull()
    per = arguments.groupBy(*key, "block").agg(
        F.max(F.when(F.col("keyword") == label, value)).alias("labelled"), F.max(F.when(positional & (F.col("argument") == 0), value)).alias("first"),
        F.min(F.when(positional & value.isNotNull(), F.struct("argument", value.alias("v"))))["v"].alias("string"),
        F.min(F.when(positional & value.isNotNull() & (F.col("argument") > 0), F.struct("argument", value.alias("v"))))["v"].alias("later"),
        F.max(F.when(F.col("keyword") == "required", F.col("value") == "True")).alias("is_required"))
    heads = found.filter("start").select(*key, "block", "name", "kind")
    rows = heads.join(per, [*key, "block"], "left").withColumn("data_type", logical).filter("data_type IS NOT NULL")
    related = F.col("data_type").isin(*relations)
    codes = declared_options(found, key, list(options)).groupBy(*key, "block").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("option", "code"))), lambda o: o["code"])).alias("codes"))
    title = F.coalesce(F.nullif(F.col("labelled"), F.lit("")), F.nullif(F.when(related, F.col("later")).otherwise(F.col("string")), F.lit("")), F.col("name"))
    return rows.join(codes, [*key, "block"], "left").select(
        *key, (F.col("block") - 1).cast("int").alias("position"), "name", own.alias("kind"), "data_type", title.alias("title"), F.when(related, F.col("first")).alias("target"), F.coalesce("is_required", F.lit(False)).alias("is_required"),
        F.when(own == "Selection", F.col("codes")).alias("allowed_values"))
