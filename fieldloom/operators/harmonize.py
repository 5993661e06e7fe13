"""Name normalization, alias mapping and survivorship merge of raw items.

Raw items carry a unique ``ord``; it stands for the order in which sources list
their items, and every "first one wins" rule is a minimum over it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import entity_of, entity_or_blank, field_of, has_dot, snake_dotted
from ..functions.rows import explode_list
from ..functions.rules import completeness_score
from ..functions.values import join_non_empty, json_quote, parse_allowed_values, truthy
from ..literals import literal_table
from ..storage import materialize

KEY = ["category", "name"]

RAW_SCHEMA = {
    "ord": "bigint", "category": "string", "name": "string", "title": "string", "description": "string",
    "data_type": "string", "byte_length": "int", "decimal_scale": "int", "is_required": "boolean",
    "is_nullable": "boolean", "default_value": "string", "allowed_values": "string", "format_mask": "string",
    "source_standard": "string", "source_url": "string", "version": "string",
}


def conform(raw: DataFrame) -> DataFrame:
    """All item columns in order; the ones a source does not have are NULL."""
    have = set(raw.columns)
    return raw.select(*[
        (F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in RAW_SCHEMA.items()
    ])


def resolve_names(raw: DataFrame, entity_aliases: Mapping[str, str], field_aliases: Mapping[str, str]) -> DataFrame:
    """Add the steps of name resolution next to the raw columns.

    ``source_entity``/``canonical_entity`` tell which entity alias fired,
    ``base_name``/``canonical_field`` which field alias did, ``clean_name`` is
    the result.
    """
    spark = raw.sparkSession
    dotted = F.col("dotted")
    df = raw.withColumn("dotted", snake_dotted(F.col("name"))).withColumn(
        "source_entity", F.when(has_dot(dotted), entity_of(dotted)))
    if entity_aliases:
        entities = literal_table(spark, ["source_entity", "canonical_entity"], entity_aliases.items())
        df = df.join(entities, "source_entity", "left")
    else:
        df = df.withColumn("canonical_entity", F.lit(None).cast("string"))
    df = df.withColumn(
        "base_name",
        F.when(F.col("canonical_entity").isNotNull(), F.concat_ws(".", "canonical_entity", field_of(dotted)))
        .otherwise(dotted))
    if field_aliases:
        fields = literal_table(spark, ["base_name", "canonical_field"], field_aliases.items())
        df = df.join(fields, "base_name", "left")
    else:
        df = df.withColumn("canonical_field", F.lit(None).cast("string"))
    return df.withColumn("clean_name", F.coalesce("canonical_field", "base_name")).drop("dotted")


def normalize_items(raw: DataFrame, entity_aliases: Mapping[str, str], field_aliases: Mapping[str, str]) -> DataFrame:
    """Raw items under their canonical names."""
    df = resolve_names(conform(raw), entity_aliases, field_aliases)
    return df.select(*[F.col("clean_name").alias("name") if c == "name" else F.col(c) for c in RAW_SCHEMA])


def alias_usage(raw: DataFrame, entity_aliases: Mapping[str, str]) -> DataFrame:
    """Entity aliases that fired and the number of items each remapped."""
    df = resolve_names(raw.select("name"), entity_aliases, {})
    return (df.filter(F.col("canonical_entity") != F.col("source_entity"))
            .groupBy("source_entity", F.col("canonical_entity").alias("canonical"))
            .agg(F.count("*").alias("items")))


def field_alias_usage(raw: DataFrame, entity_aliases: Mapping[str, str], field_aliases: Mapping[str, str]) -> DataFrame:
    """Field aliases that fired, after the entity aliases."""
    df = resolve_names(raw.select("name"), entity_aliases, field_aliases)
    return (df.filter(F.col("canonical_field").isNotNull())
            .groupBy(F.col("base_name").alias("source_field"), F.col("canonical_field").alias("canonical"))
            .agg(F.count("*").alias("items")))


# --- survivorship -----------------------------------------------------------

def _earliest() -> Column:
    return -F.col("ord")


def primary_row(columns: list[str]) -> Column:
    """Most complete member, the earliest one on ties."""
    return F.max_by(F.struct(*columns), F.struct(completeness_score().alias("s"), _earliest().alias("o")))


def longest_description() -> Column:
    text = F.when(truthy(F.col("description")), F.col("description"))
    return F.max_by(text, F.when(text.isNotNull(), F.struct(F.length(text).alias("n"), _earliest().alias("o"))))


def first_title() -> Column:
    title = F.when(truthy(F.col("title")), F.col("title"))
    return F.min_by(title, F.when(title.isNotNull(), F.col("ord")))


def any_required() -> Column:
    return F.bool_or(F.coalesce(F.col("is_required"), F.lit(False)))


# Kinds of provenance facts.
SOURCE, URL, VERSION, VALUE = "s", "u", "v", "a"


def _facts(norm: DataFrame, key: list[str], kinds: tuple[str, ...]) -> DataFrame:
    """Distinct (key, kind, owner, value) with the rank of the first occurrence.

    This long form is what keeps a hot key harmless: partial aggregation runs
    before the shuffle, the shuffle spreads one key over its distinct values,
    and only distinct values are ever gathered per key.  Allowed values are
    parsed once for each distinct text of an owner, not for each item: equal
    texts have equal members, and the earliest item brings them first.
    """
    nothing = F.lit(None).cast("string")

    def fact(kind: str, owner: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), owner.alias("owner"), value.alias("value"))

    single = {SOURCE: "source_standard", URL: "source_url", VERSION: "version"}
    cells = [fact(k, nothing, F.col(single[k])) for k in kinds if k in single]
    if VALUE in kinds:
        owner = F.when(truthy(F.col("source_standard")), F.col("source_standard")).otherwise("unknown")
        cells.append(fact(VALUE, owner, F.col("allowed_values")))
    group = [*key, "kind", "owner", "value"]
    kept = (F.col("kind") == SOURCE) | truthy(F.col("value"))
    rows = explode_list(norm, [*key, "ord"], F.array(*cells), "f").select(*key, "ord", "f.*").filter(kept)
    rows = rows.groupBy(*group).agg(F.min("ord").alias("ord"))
    if VALUE in kinds:
        member = lambda v, i: F.struct(v.alias("value"), i.cast("int").alias("pos"))
        members = F.when(F.col("kind") == VALUE, F.transform(parse_allowed_values(F.col("value")), member)).otherwise(F.array(member(F.col("value"), F.lit(0))))
        rows = explode_list(rows, [*key, "kind", "owner", "ord"], members, "m").select(*key, "kind", "owner", "ord", "m.*").filter(kept)
    else:
        rows = rows.withColumn("pos", F.lit(0))
    # One decimal holds (ord, position): a fixed-width buffer keeps this a hash aggregate. No list has 2**31 members.
    rank = F.col("ord").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")
    return rows.groupBy(*group).agg(F.min(rank).alias("rank"))


def collect_facts(norm: DataFrame, key: list[str], kinds: tuple[str, ...]) -> DataFrame:
    """Per key the distinct facts in order of first occurrence."""
    return _facts(norm, key, kinds).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("rank", "kind", "owner", "value"))).alias("facts"))


def distinct_values(kind: str) -> Column:
    return F.transform(F.filter("facts", lambda f: (f["kind"] == kind) & truthy(f["value"])), lambda f: f["value"])


def count_sources() -> Column:
    """Distinct sources, a missing one counted as a source of its own."""
    return F.size(F.filter("facts", lambda f: f["kind"] == SOURCE)).cast("bigint")


def joined_sources() -> Column:
    return join_non_empty(distinct_values(SOURCE), "; ")


def joined_urls() -> Column:
    return join_non_empty(distinct_values(URL), " | ")


def joined_versions() -> Column:
    return join_non_empty(distinct_values(VERSION), "; ")


def add_merged_values(df: DataFrame, name: str = "merged_values") -> DataFrame:
    """Allowed values of a merged key, from its ``facts``.

    One vocabulary, or equal ones, give a flat array; different ones give an
    object keyed by source, sorted by the sources' plain names; no values give NULL.
    """
    df = df.withColumn("__values", F.filter("facts", lambda f: f["kind"] == VALUE))
    df = df.withColumn("__owners", F.array_distinct(F.transform("__values", lambda f: f["owner"])))
    df = df.withColumn("__lists", F.transform(
        "__owners",
        lambda o: F.transform(F.filter("__values", lambda f: f["owner"] == o), lambda f: f["value"])))
    agree = F.size(F.array_distinct(F.transform("__lists", lambda vs: F.array_sort(vs)))) == 1
    flat = F.concat(F.lit("["), F.array_join(F.array_distinct(F.flatten("__lists")), ","), F.lit("]"))
    pairs = F.array_sort(F.arrays_zip(F.col("__owners").alias("o"), F.col("__lists").alias("vs")))
    by_source = F.concat(
        F.lit("{"),
        F.array_join(F.transform(pairs, lambda p: F.concat(
            json_quote(p["o"]), F.lit(":["), F.array_join(p["vs"], ","), F.lit("]"))), ","),
        F.lit("}"))
    df = df.withColumn(name, F.when(F.size("__owners") == 0, F.lit(None)).when(agree, flat).otherwise(by_source))
    return df.drop("__values", "__owners", "__lists")


CATALOG_COLUMNS = [
    "category", "name", "title", "description", "data_type", "byte_length", "decimal_scale", "is_required",
    "is_nullable", "default_value", "allowed_values", "format_mask", "source_standard", "source_url", "version",
    "first_ord", "n_members", "n_sources",
]


def _encoded(c: str) -> Column:
    """A nullable text as a text that is never NULL, so that it can be a join key."""
    return F.when(F.col(c).isNull(), "").otherwise(F.concat(F.lit("="), c))


def _decoded(c: str) -> Column:
    return F.when(F.col(c) != "", F.substr(c, F.lit(2)))


def join_by_key(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which missing parts of a key equal each other; the key columns are those of ``left``."""
    other = right.withColumnsRenamed({c: f"__{c}" for c in key})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
    joined = left.join(other, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__{c}" for c in key])


def only_merging(norm: DataFrame, key: list[str]) -> DataFrame:
    """Items whose key has several members; missing parts of a key equal each other.

    The keys are found from the key columns alone and written, so their true size
    decides between a broadcast and a shuffled semi join.
    """
    several = materialize(norm.groupBy(*key).count().filter("count > 1").select(*key), "several")
    return join_by_key(norm, several, key, "left_semi")


def merge_items(norm: DataFrame, key: list[str] | None = None, preselect: bool = True) -> DataFrame:
    """One row per key: lone items unchanged, the others merged by the rules.

    Two aggregations over the same key are joined without another shuffle: the
    survivors (one row per key and map task after partial aggregation) and the
    distinct provenance facts.

    ``preselect`` runs jobs while the plan is built: it writes the input once, finds
    the keys with several members by one narrow pass over that table, and makes
    facts for their items only.  Lone items, most of a usual catalog, then stay out
    of the wider shuffles.  Without it the plan is entirely lazy.  Missing categories
    and names are keys like any other.
    """
    key = key or KEY
    nullable = [c for c in key if dict(norm.dtypes)[c] == "string"]
    encoded = {c: f"__{c}" for c in nullable}
    norm = norm.withColumns({k: _encoded(c) for c, k in encoded.items()})
    if preselect:
        norm = materialize(norm, "items")
    on = [encoded.get(c, c) for c in key]
    payload = [c for c in RAW_SCHEMA if c not in key and c != "ord"]
    core = norm.groupBy(*on).agg(
        F.count("*").alias("n_members"),
        F.min("ord").alias("first_ord"),
        primary_row(payload).alias("p"),
        longest_description().alias("longest"),
        first_title().alias("first_title"),
        F.max("byte_length").alias("max_length"),
        any_required().alias("required"),
    )
    merging = only_merging(norm, on) if preselect else norm
    facts = collect_facts(merging, on, (SOURCE, URL, VERSION, VALUE))
    df = core.join(facts, on, "left" if preselect else "inner")
    df = add_merged_values(df)
    lone = F.col("n_members") == 1

    def pick(single: Column, merged: Column) -> Column:
        return F.when(lone, single).otherwise(merged)

    p = F.col("p")
    out = {
        "title": pick(p["title"], F.coalesce(F.when(truthy(p["title"]), p["title"]), F.col("first_title"))),
        "description": pick(p["description"], F.col("longest")),
        "data_type": p["data_type"],
        "byte_length": pick(p["byte_length"], F.col("max_length")),
        "decimal_scale": p["decimal_scale"],
        "is_required": pick(F.coalesce(p["is_required"], F.lit(False)), F.col("required")),
        "is_nullable": pick(F.coalesce(p["is_nullable"], F.lit(True)), ~F.col("required")),
        "default_value": p["default_value"],
        "allowed_values": pick(p["allowed_values"], F.col("merged_values")),
        "format_mask": p["format_mask"],
        "source_url": pick(p["source_url"], joined_urls()),
        "version": pick(p["version"], joined_versions()),
        "n_sources": pick(F.lit(1).cast("bigint"), count_sources()),
    }
    out |= {c: _decoded(k) for c, k in encoded.items()}
    if "source_standard" not in key:
        out["source_standard"] = pick(p["source_standard"], joined_sources())
    extra = [c for c in key if c not in CATALOG_COLUMNS]
    return df.select(*[out[c].alias(c) if c in out else F.col(c) for c in CATALOG_COLUMNS], *[out.get(c, F.col(c)).alias(c) for c in extra])


def with_item_id(catalog: DataFrame) -> DataFrame:
    """A surrogate key that stays the same across rebuilds."""
    return catalog.withColumn("item_id", F.xxhash64("category", "name", "source_standard"))


# --- reports ----------------------------------------------------------------

def group_concepts(norm: DataFrame) -> DataFrame:
    return norm.groupBy(*KEY).agg(
        F.count("*").alias("n_members"),
        (F.count_distinct("source_standard") + F.max(F.col("source_standard").isNull().cast("bigint"))).alias("n_sources"))


def merge_report(norm: DataFrame) -> DataFrame:
    """Keys confirmed by several sources, their sources and member counts."""
    facts = _facts(norm, KEY, (SOURCE,))
    counts = norm.groupBy(*KEY).agg(F.count("*").alias("count"))
    sources = facts.groupBy(*KEY).agg(
        F.count("*").alias("n_sources"),
        F.array_sort(F.collect_list(F.struct("rank", "kind", "owner", "value"))).alias("facts"))
    return (join_by_key(sources.filter(F.col("n_sources") > 1), counts, KEY)
            .select(*KEY, joined_sources().alias("sources"), F.col("count")))


def related_concepts(catalog: DataFrame) -> DataFrame:
    """Fields shared by several entities and several single sources."""
    members = catalog.select(
        "category", field_of(F.col("name")).alias("field"),
        F.explode(F.concat(
            F.array(F.struct(F.lit("e").alias("kind"), entity_or_blank(F.col("name")).alias("value"))),
            F.transform(F.split(F.coalesce("source_standard", F.lit("")), "; "),
                        lambda s: F.struct(F.lit("s").alias("kind"), s.alias("value"))),
        )).alias("m")).select("category", "field", "m.*").distinct()
    is_entity, is_source = F.col("kind") == "e", F.col("kind") == "s"
    return (members.groupBy("category", "field")
            .agg(F.array_sort(F.collect_list(F.when(is_entity, F.col("value")))).alias("es"),
                 F.array_sort(F.collect_list(F.when(is_source, F.col("value")))).alias("ss"))
            .filter((F.size("es") > 1) & (F.size("ss") > 1))
            .select("category", "field", F.array_join("es", ", ").alias("entities"),
                    F.array_join("ss", ", ").alias("sources")))


def merge_summary(catalog: DataFrame) -> DataFrame:
    """One row: raw items, clean items, cross-source merges, related concepts."""
    totals = catalog.agg(
        F.coalesce(F.sum("n_members"), F.lit(0)).alias("input_items"),
        F.count("*").alias("output_items"),
        F.count_if((F.col("n_members") > 1) & (F.col("n_sources") > 1)).alias("merged_concepts"))
    related = related_concepts(catalog).agg(F.count("*").alias("related_concepts"))
    tall = totals.selectExpr("stack(3, 'input_items', input_items, 'output_items', output_items, "
                             "'merged_concepts', merged_concepts) AS (metric, n)").unionByName(
        related.selectExpr("'related_concepts' AS metric", "related_concepts AS n"))
    return tall.agg(*[F.max(F.when(F.col("metric") == m, F.col("n"))).alias(m)
                      for m in ("input_items", "output_items", "merged_concepts", "related_concepts")])
