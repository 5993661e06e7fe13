"""Counts over the catalog: sources, categories, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.rules import coverage_grade, is_blank
from .enrich import one_text_per_name

def atomic_sources(joined: Column, separator: str = ";") -> Column:
    """Single sources of a joined list, trimmed, blanks dropped, order kept."""
    parts = F.transform(F.split(F.coalesce(joined, F.lit("")), separator), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def explode_sources(items: DataFrame, *columns: str) -> DataFrame:
    return items.select(*columns, F.explode(atomic_sources(F.col("source_standard"))).alias("source"))


def source_category_counts(items: DataFrame) -> DataFrame:
    """Items per category and single source; small after partial aggregation."""
    return explode_sources(items, "category").groupBy("category", "source").agg(F.count("*").alias("n"))


def source_category_matrix(items: DataFrame, sources: list[str]) -> DataFrame:
    """Category by the given sources with row and column totals; ``source_category_counts`` has all of them as rows."""
    counts = source_category_counts(items)
    cells = [F.coalesce(F.sum(F.when(F.col("source") == s, F.col("n"))), F.lit(0)).alias(s) for s in sources]
    return (counts.rollup("category").agg(F.grouping_id().alias("g"), *cells, F.sum("n").alias("total"))
            .withColumn("category", F.when(F.col("g") == 1, "Total").otherwise(F.col("category"))).drop("g"))


def source_category_edges(items: DataFrame) -> DataFrame:
    """Flow from source to category, the largest categories and edges first."""
    counts = source_category_counts(items)
    return (counts.withColumn("category_total", F.sum("n").over(W.partitionBy("category")))
            .orderBy(F.desc("category_total"), "category", F.desc("n"), "source"))


def dictionary_stats(items: DataFrame, categories: DataFrame) -> DataFrame:
    """Items per category next to the overall totals."""
    per_category = category_counts(items, categories)
    total = items.agg(F.count("*")).scalar()
    n_categories = categories.agg(F.count("*")).scalar()
    n_sources = explode_sources(items).distinct().agg(F.count("*")).scalar()
    return per_category.select("category", "items", total.alias("data_items"), n_categories.alias("categories"),
                               n_sources.alias("source_standards"))


def category_counts(items: DataFrame, categories: DataFrame) -> DataFrame:
    """Items per category, empty categories kept."""
    counts = items.groupBy("category").agg(F.count("*").alias("items"))
    return (categories.select(F.col("name").alias("category")).join(counts, "category", "left")
            .select("category", F.coalesce("items", F.lit(0)).alias("items")))


def coverage(items: DataFrame, curated: DataFrame) -> DataFrame:
    """Origin of descriptions per category, with a row for all of them."""
    texts = one_text_per_name(curated).withColumnRenamed("description", "curated_text")
    missing = is_blank(F.col("description"))
    is_curated = ~missing & F.coalesce(F.col("description") == F.col("curated_text"), F.lit(False))
    per_category = (items.select("category", "name", "description").join(texts, "name", "left")
                    .groupBy("category").agg(
                        F.count("*").alias("items"), F.count_if(missing).alias("missing"),
                        F.count_if(is_curated).alias("curated")))
    out = per_category.rollup("category").agg(
        F.grouping_id().alias("g"), *[F.sum(c).alias(c) for c in ("items", "missing", "curated")])
    out = out.withColumn("from_source", F.col("items") - F.col("missing") - F.col("curated"))
    percent = F.lit(100.0) * (F.col("from_source") + F.col("curated")).cast("double") / F.col("items").cast("double")
    return out.select(F.when(F.col("g") == 1, "All").otherwise(F.col("category")).alias("category"),
                      "items", "from_source", "curated", "missing", percent.alias("percent"))


def graded_coverage(items: DataFrame, curated: DataFrame) -> DataFrame:
    return coverage(items, curated).select("category", "percent", coverage_grade(F.col("percent")).alias("grade"))
