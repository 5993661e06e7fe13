"""Files written from the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, new_path

CSV_COLUMNS = ["name", "title", "data_type", "byte_length", "is_required", "allowed_values", "source_standard"]


def write_catalog(catalog: DataFrame) -> DataFrame:
    """Persist the catalog by category and return the rows read back."""
    return materialize(catalog, "write", "category")


def export_csv(catalog: DataFrame, category: str) -> tuple[str, DataFrame]:
    """Header CSV of one category in name order; the path and the rows read back.

    The sort is a range partitioning: the files in order hold the whole sorted
    table, and no task sees more than its range.  NULL and the empty text are
    told apart by an explicit marker.
    """
    spark = catalog.sparkSession
    rows = catalog.filter(F.col("category") == category).select(*CSV_COLUMNS)
    path = new_path(spark, "csv")
    options = {"header": True, "nullValue": "\\N", "emptyValue": "", "escape": '"'}
    rows.orderBy("name").write.options(**options).csv(path)
    return path, spark.read.options(**options).schema(rows.schema).csv(path)


def export_entity_json(catalog: DataFrame, entity: str) -> tuple[str, DataFrame]:
    """One JSON array with an object per field of an entity.

    The files, concatenated in order, are the document: every row is one line
    that starts with ``[`` or ``,`` and the last one ends with ``]``.  The first
    and the last row come from one global aggregation, so a large entity is
    written by many tasks.
    """
    spark = catalog.sparkSession
    rows = catalog.filter(F.startswith("name", F.lit(entity + "."))).select(
        F.struct("name", "category").alias("k"),
        F.to_json(F.struct("name", F.col("data_type").alias("type"), F.col("is_required").alias("required"), "description"),
                  {"ignoreNullFields": "false"}).alias("body"))
    ends = rows.agg(F.min("k").alias("low"), F.max("k").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    lines = rows.orderBy("k").select(F.concat(
        F.when(F.col("k") == low, "[").otherwise(","), "body", F.when(F.col("k") == high, "]").otherwise("")).alias("value"))
    path = new_path(spark, "json")
    lines.write.text(path)
    return path, spark.read.text(path)
