"""Search by business term, for many terms in one plan.

A term is resolved by the first level with hits: category, entity, alias, then
keyword.  The first three levels are decided between terms and the distinct
category and entity names; items are only touched by the final join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import entity_of
from ..storage import materialize
from .ranges import match_ranges

LEVELS = ["category", "entity", "alias", "keyword"]
# Characters of a literal by which terms and texts meet.
GRAM = 3


# --- substring matching -----------------------------------------------------

def _occurs(texts: list[str], lookup: Column | str) -> Column:
    """Whether the term is in one of the texts; ``%`` and ``_`` in it act as wildcards, a backslash does not."""
    pattern = F.concat(F.lit("%"), F.replace(lookup, F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    out = F.lit(False)
    for t in texts:
        out = out | F.like(F.lower(F.coalesce(F.col(t), F.lit(""))), pattern)
    return out


def _pieces(text: Column, size: Column) -> Column:
    """All distinct parts of ``size`` characters; none for size 0."""
    last = F.length(text) - size + 1
    return F.when((size > 0) & (last > 0), F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, size))))


def anchors(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lookup, gram): for each term of ``wanted`` (lookup, gram) its rarest gram in ``found`` (gram, ...); terms with a gram that no row has are left out."""
    frequency = found.groupBy("gram").agg(F.count("*").alias("rows"))
    weighed = wanted.join(frequency, "gram", "left")
    best = weighed.groupBy("lookup").agg(F.min(F.struct("rows", "gram")).alias("best"), F.max(F.col("rows").isNull()).alias("hopeless"))
    return best.filter(~F.col("hopeless")).select("lookup", F.col("best.gram").alias("gram"))


def match_substrings(rows: DataFrame, key: list[str], texts: list[str], terms: DataFrame) -> DataFrame:
    """``rows`` paired with every term that occurs in one of ``texts``; ``key`` names a row.

    Terms and rows meet by *grams*, parts of up to ``GRAM`` characters of a term's literal runs.
    Which rows have which of the terms' grams is written once, as keys and grams; the rarest
    gram of a term is its anchor, so that a term with one rare part meets few rows, whatever its
    other parts. Rows with equal keys give one pair. The rows come back by key, and the whole
    pattern is checked. A term of wildcards alone asks for a least length of a text: it meets
    the rows as a range of lengths. Missing terms are ignored.
    """
    runs = F.split("lookup", "[%_]")
    longest = F.array_max(F.transform(runs, lambda r: F.length(r)))
    wanted = terms.select("lookup").filter("lookup IS NOT NULL").distinct().withColumn("size", F.least(longest, F.lit(GRAM)))
    run = F.aggregate(runs, F.lit(""), lambda a, r: F.when(F.length(r) > F.length(a), r).otherwise(a))
    size = F.col("size")
    # one gram after the other along the longest run, and its last one
    grams = F.transform(F.sequence(F.lit(0), F.floor((longest - 1) / size)), lambda i: F.substr(run, F.least(i * size, longest - size) + 1, size))
    parts = materialize(wanted.filter("size > 0").select("lookup", "size", F.explode(F.array_distinct(grams)).alias("gram")), "grams")
    sizes = parts.agg(F.sort_array(F.collect_set("size"))).scalar()          # GRAM numbers at most
    # a gram that spans two texts costs a check only
    text = F.lower(F.concat_ws("\n", *[F.coalesce(F.col(t), F.lit("")) for t in texts]))
    cut = rows.select(*key, text.alias("__text")).withColumn("size", F.explode(sizes))
    cut = cut.select(*key, F.explode(_pieces(F.col("__text"), F.col("size"))).alias("gram"))
    found = materialize(cut.join(parts.select("gram").distinct(), "gram", "left_semi").select("gram", *[F.col(c).alias(f"__{c}") for c in key]), "found-grams")
    pairs = found.join(anchors(found, parts.select("lookup", "gram")), "gram").drop("gram").distinct()
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    hits = rows.join(pairs, same).filter(_occurs(texts, "lookup")).select(*rows.columns, "lookup")
    least = F.length(F.replace("lookup", F.lit("%"), F.lit(""))).cast("bigint")
    blank = wanted.filter("size = 0").select("lookup", least.alias("lo"), F.lit((1 << 61) - 1).alias("hi"))
    length = F.greatest(F.lit(-1), *[F.length(F.coalesce(F.col(t), F.lit(""))) for t in texts])
    long_enough = match_ranges(rows.withColumn("__length", length), "__length", blank).select(*rows.columns, "lookup")
    return hits.unionByName(long_enough)


# --- selectors ---------------------------------------------------------------

def item_names(items: DataFrame) -> DataFrame:
    """Distinct ``(category, entity)``: all that the first three levels look at."""
    return items.select("category", entity_of(F.col("name")).alias("entity")).distinct()


def _lookups(terms: DataFrame) -> DataFrame:
    return terms.withColumn("lookup", F.lower("term"))


def category_selectors(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(lookup, category)``: the text occurs in the category's name."""
    return match_substrings(names.select("category").distinct(), ["category"], ["category"], wanted).select("lookup", "category")


def entity_selectors(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(lookup, entity)``: the entity itself, or one that goes on with ``_`` or ``.``.

    Each entity lists its prefixes that end at such a boundary; an equi-join finds
    the wanted ones.
    """
    low = F.lower("entity")
    ends = F.filter(F.sequence(F.lit(1), F.length(low)),
                    lambda i: (i == F.length(low)) | F.substr(low, i + 1, F.lit(1)).isin("_", "."))
    prefixes = names.select("entity").distinct().filter("entity <> ''").select(
        "entity", F.explode(F.transform(ends, lambda i: F.substr(low, F.lit(1), i))).alias("lookup"))
    return prefixes.join(wanted.select("lookup").distinct(), "lookup").select("lookup", "entity")


def alias_selectors(names: DataFrame, terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names behind the alias targets: entities, or categories where no entity fits.

    A name reached through several targets belongs to the earliest one.
    """
    keys = aliases.select(F.lower("term").alias("lookup"), "target_pos", "target")
    targets = _lookups(terms).join(keys, "lookup").select(
        "term_pos", "term", "target_pos", "target", F.lower("target").alias("lookup"))
    entities = entity_selectors(names, targets)
    others = targets.join(entities.select("lookup").distinct(), "lookup", "left_anti")
    found = targets.join(entities, "lookup").join(names, "entity").unionByName(
        others.join(category_selectors(names, others), "lookup").join(names, "category"))
    return found.select("term_pos", "term", "target_pos", "target", "category", "entity")


def _named(names: DataFrame, terms: DataFrame, selectors: DataFrame, on: str) -> DataFrame:
    return _lookups(terms).join(selectors, "lookup").join(names, on).select("term_pos", "term", "category", "entity")


def _pick(items: DataFrame, chosen: DataFrame) -> DataFrame:
    """Items of the chosen ``(category, entity)`` names: one scan, one join."""
    extra = [c for c in chosen.columns if c not in ("category", "entity")]
    full = items.withColumn("entity", entity_of(F.col("name")))
    return full.join(chosen, ["category", "entity"]).select(*extra, *items.columns)


# --- single levels ------------------------------------------------------------

def search_category(items: DataFrame, terms: DataFrame) -> DataFrame:
    wanted = _lookups(terms)
    selectors = category_selectors(items.select("category"), wanted)
    return wanted.join(selectors, "lookup").join(items, "category").drop("lookup")


def search_entity(items: DataFrame, terms: DataFrame) -> DataFrame:
    names = item_names(items)
    return _pick(items, _named(names, terms, entity_selectors(names, _lookups(terms)), "entity"))


def search_keyword(items: DataFrame, terms: DataFrame) -> DataFrame:
    wanted = _lookups(terms)
    return wanted.join(match_substrings(items, ["category", "name"], ["name", "title", "description"], wanted), "lookup").drop("lookup")


def _first_target(selectors: DataFrame) -> DataFrame:
    return selectors.groupBy("term_pos", "term", "category", "entity").agg(F.min("target_pos").alias("target_pos"))


def _one_per_name(hits: DataFrame, items: DataFrame) -> DataFrame:
    """Alias hits hold each name once: the earliest target and category bring it."""
    rest = [c for c in items.columns if c != "name"]
    picked = hits.groupBy("term_pos", "term", "name").agg(
        F.min_by(F.struct(*rest), F.struct("target_pos", "category")).alias("r"))
    return picked.select("term_pos", "term", "name", "r.*")


def search_alias(items: DataFrame, terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """Items of all alias targets, and ``targets``, the list of those with items."""
    selectors = materialize(alias_selectors(materialize(item_names(items), "names"), terms, aliases), "selectors")
    listed = selectors.select("term_pos", "target_pos", "target").distinct().groupBy("term_pos").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("target_pos", "target"))),
                                 lambda t: t["target"]), ", ").alias("targets"))
    hits = _one_per_name(_pick(items, _first_target(selectors)), items)
    return hits.join(listed, "term_pos")


# --- all levels ----------------------------------------------------------------

def resolve(items: DataFrame, terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """``(term_pos, term, level, item...)`` by the first level with hits.

    The distinct names are written once, and the names each term selects after
    them; both are small next to the items.  Items are then read once for the
    selected names, once for alias hits, and once more only if terms without any
    selected name remain for the keyword level.
    """
    names = materialize(item_names(items), "names")

    def level(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("level", F.lit(name))

    cats = _named(names, terms, category_selectors(names, _lookups(terms)), "category")
    ents = _named(names, terms, entity_selectors(names, _lookups(terms)), "entity")
    found = level(cats, LEVELS[0]).unionByName(level(ents, LEVELS[1]))
    best = found.groupBy("term_pos").agg(F.min("level").alias("level"))      # "category" sorts before "entity"
    direct = materialize(found.join(best, ["term_pos", "level"], "left_semi"), "direct")
    rest = terms.join(direct.select("term_pos"), "term_pos", "left_anti")
    aliased = materialize(_first_target(alias_selectors(names, rest, aliases)), "aliased")
    rest = rest.join(aliased.select("term_pos"), "term_pos", "left_anti")
    cols = ["term_pos", "term", "level", *items.columns]
    out = _pick(items, direct).select(*cols)
    if not aliased.isEmpty():
        out = out.unionByName(level(_one_per_name(_pick(items, aliased), items), LEVELS[2]).select(*cols))
    if not rest.isEmpty():
        out = out.unionByName(level(search_keyword(items, rest), LEVELS[3]).select(*cols))
    return out


# --- results ----------------------------------------------------------------

def summary(items: DataFrame, terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per term the level and the numbers of items, entities and categories."""
    hits = resolve(items, terms, aliases).withColumn("entity", entity_of(F.col("name")))
    # Distinct (entity, category) counts first: a term with very many items stays cheap.
    small = hits.groupBy("term_pos", "level", "entity", "category").agg(F.count("*").alias("n"))
    totals = small.groupBy("term_pos", "level").agg(
        F.sum("n").alias("items"), F.count_distinct("entity").alias("entities"), F.count_distinct("category").alias("categories"))
    counted = terms.join(totals, "term_pos", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("items", "entities", "categories")]
    return counted.select("term_pos", "term", F.coalesce("level", F.lit("keyword")).alias("level"), *zero)


def top_n(hits: DataFrame, n: int) -> DataFrame:
    """First ``n`` items per term by name, and how many are left out.

    The rank filter lets every task drop all but its own first ``n`` rows per term
    before the shuffle; totals come from a separate partial aggregation.
    """
    totals = hits.groupBy("term_pos").agg(F.count("*").alias("total"))
    rank = F.row_number().over(W.partitionBy("term_pos").orderBy("name", "category"))
    first = hits.withColumn("rank", rank).filter(F.col("rank") <= n)
    return first.join(totals, "term_pos").withColumn("more", F.greatest(F.col("total") - n, F.lit(0))).drop("total")


def union_terms(hits: DataFrame) -> DataFrame:
    """Items of all terms, one per name: the first term brings it."""
    rest = [c for c in hits.columns if c not in ("name", "term_pos")]
    return (hits.groupBy("name").agg(F.min_by(F.struct("term_pos", *rest), F.struct("term_pos", "category")).alias("r"))
            .select("name", "r.*"))


def term_matches(items: DataFrame, terms: DataFrame) -> DataFrame:
    """Every (term, item) pair with the way it matches."""
    cols = ["term_pos", "category", "name", "kind"]

    def kind(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("kind", F.lit(name)).select(*cols)

    return (kind(search_category(items, terms), "category").unionByName(kind(search_entity(items, terms), "entity"))
            .unionByName(kind(search_keyword(items, terms), "text")))
