"""Item batches that arrive over time.

Every micro-batch is appended to a log, one folder per epoch.  A repeated epoch
overwrites its own folder, so at-least-once delivery changes nothing, and the
cost of a micro-batch depends on its own size only.  The current items are read
from the log: per column the newest value by the batch number in the data, which
makes the order of arrival irrelevant.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import ITEM_COLUMNS, ITEM_KEY, latest_values

SEQ = "batch_seq"


def run(spark: SparkSession, schema, source: str, log: str, checkpoint: str, files_per_trigger: int | None = None) -> None:
    """Append everything new below ``source`` to ``log`` and stop.

    Items hold at most one row per natural key and batch number.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def append(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/epoch={epoch}")

    query = (reader.parquet(source).writeStream.foreachBatch(append)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_log(spark: SparkSession, schema, log: str) -> DataFrame:
    return spark.read.schema(schema).parquet(log)


def current_items(log: DataFrame) -> DataFrame:
    return latest_values(log, ITEM_KEY, ITEM_COLUMNS, SEQ)


def still_needed(log: DataFrame) -> DataFrame:
    """Log rows that still provide a value: what a compacted log has to keep."""
    newest = log.groupBy(*ITEM_KEY).agg(F.array_compact(F.array_distinct(F.array(*[
        F.max(F.when(F.col(c).isNotNull(), F.col(SEQ))) for c in ITEM_COLUMNS]))).alias("seqs"))
    keep = newest.select(*ITEM_KEY, F.explode("seqs").alias(SEQ)).alias("k")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"k.{c}")) for c in [*ITEM_KEY, SEQ]]
    return log.alias("l").join(keep, reduce(lambda a, b: a & b, on), "left_semi")
