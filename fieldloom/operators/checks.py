"""Invariants of the catalog and of its projection: ``(check, bad, ok)`` rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import is_blank
from .enrich import unmatched_overrides
from .projection import BYTES_PER_CHAR


def _stacked(counts: DataFrame, *names: str) -> DataFrame:
    """One row per named count of a one-row table."""
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("bad")) for n in names])
    return counts.select(F.inline(pairs)).withColumn("ok", F.col("bad") == 0)


def _rows(name: str, offenders: DataFrame) -> DataFrame:
    return _stacked(offenders.agg(F.count("*").alias(name)), name)


def _at_least_one(name: str, table: DataFrame) -> DataFrame:
    return _stacked(table.limit(1).agg((F.lit(1) - F.count("*")).alias(name)), name)


def nonempty(items: DataFrame, categories: DataFrame) -> DataFrame:
    return _at_least_one("items_nonempty", items).unionByName(_at_least_one("categories_nonempty", categories))


def description(items: DataFrame) -> DataFrame:
    return _stacked(items.agg(F.count_if(is_blank(F.col("description"))).alias("missing_description")), "missing_description")


def empty_category(items: DataFrame, categories: DataFrame) -> DataFrame:
    used = items.select(F.col("category").alias("name")).distinct()
    return _rows("empty_category", categories.join(used, "name", "left_anti"))


def orphan_curated(items: DataFrame, curated: DataFrame) -> DataFrame:
    return _rows("orphan_curated", unmatched_overrides(items, curated))


def ui_complete(items: DataFrame, ui: DataFrame, groups: DataFrame) -> DataFrame:
    sizes = items.agg(F.count("*").alias("n")).unionByName(ui.agg((-F.count("*")).alias("n")))
    return _stacked(sizes.agg(F.abs(F.sum("n")).alias("ui_item_count")), "ui_item_count").unionByName(
        _at_least_one("ui_groups_nonempty", groups))


def ui_lengths(ui: DataFrame) -> DataFrame:
    """Both length rules in one scan."""
    bytes_off = ~F.col("byte_length").eqNullSafe(F.col("char_length") * BYTES_PER_CHAR)
    chars_off = F.col("char_length").isNull() | (F.col("char_length") <= 0)
    names = ("ui_byte_length", "ui_char_length")
    return _stacked(ui.agg(F.count_if(bytes_off).alias(names[0]), F.count_if(chars_off).alias(names[1])), *names)


def unique_key(items: DataFrame, ui: DataFrame) -> DataFrame:
    def repeated(name: str, df: DataFrame, key: list[str]) -> DataFrame:
        return _rows(name, df.groupBy(*key).count().filter("count > 1"))

    return repeated("duplicate_natural_key", items, ["category", "name", "source_standard"]).unionByName(
        repeated("duplicate_ui_key", ui, ["group_id", "name"]))


def ui_foreign_keys(ui: DataFrame, groups: DataFrame, categories: DataFrame) -> DataFrame:
    return _rows("ui_item_without_group", missing_groups(ui, groups)).unionByName(
        _rows("ui_group_without_category", groups.join(categories, "category_id", "left_anti")))


def missing_groups(ui: DataFrame, groups: DataFrame) -> DataFrame:
    return ui.join(groups.select("group_id"), "group_id", "left_anti")


def report(items: DataFrame, categories: DataFrame, curated: DataFrame, ui: DataFrame, groups: DataFrame) -> DataFrame:
    """Every check in one table."""
    parts = [
        nonempty(items, categories), description(items), empty_category(items, categories),
        orphan_curated(items, curated), ui_complete(items, ui, groups), ui_lengths(ui), unique_key(items, ui),
        ui_foreign_keys(ui, groups, categories),
    ]
    return reduce(DataFrame.unionByName, parts)


#: Parts that two builds are compared by.
PARTS = 1024


def digests(build: DataFrame, parts: int = PARTS) -> DataFrame:
    """(part, n, a, b): rows dealt over parts by a hash of all columns, with their number and the sums of two hashes.

    Sums do not depend on the order of rows and do respect repeated ones; they combine before the shuffle,
    so that a part costs one row of each task.
    """
    columns = sorted(build.columns)
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(len(columns)), *reversed(columns))
    wide = build.select(F.pmod(first, F.lit(parts)).alias("part"), first.cast("decimal(20,0)").alias("a"), second.cast("decimal(20,0)").alias("b"))
    return wide.groupBy("part").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def differing_parts(first: DataFrame, second: DataFrame, parts: int = PARTS) -> list[int]:
    """Parts whose digests differ or that only one build has: as many as there are parts at most."""
    both = digests(first, parts).unionByName(digests(second.select(*first.columns), parts))
    return sorted(r["part"] for r in both.groupBy("part", "n", "a", "b").count().filter("count <> 2").select("part").distinct().collect())


def content_difference(first: DataFrame, second: DataFrame, parts: int = PARTS) -> DataFrame:
    """Rows in one build but not in the other, duplicates respected.

    Digests are compared first; only rows of parts where they differ are shuffled and compared
    in full. Builds that agree move one row per part and task. Both builds must give the same
    rows each time they are read. That two different parts agree in number and both sums takes
    a collision of 128 bits.
    """
    second = second.select(*first.columns)
    wanted = differing_parts(first, second, parts)
    part = F.pmod(F.xxhash64(*sorted(first.columns)), F.lit(parts)).isin(wanted) if wanted else F.lit(False)
    one, two = first.filter(part), second.filter(part)
    return (one.exceptAll(two).withColumn("only_in", F.lit("first"))
            .unionByName(two.exceptAll(one).withColumn("only_in", F.lit("second"))))
