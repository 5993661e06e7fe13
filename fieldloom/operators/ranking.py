"""Row numbers over a whole table without putting it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..literals import literal_table
from ..storage import materialize


def with_global_rank(df: DataFrame, order_by: list[str], name: str, start: int = 1) -> DataFrame:
    """Number rows by ``order_by`` (which must be unique).

    The rows are range partitioned and written together with their partition
    number, so that both later passes see the same ranges and ``df`` is computed
    once.  Each partition is then numbered on its own and shifted by the rows
    before it.  Only one count per partition reaches the driver.
    """
    part, shift = "__part", "__shift"
    ranged = materialize(df.repartitionByRange(*order_by).withColumn(part, F.spark_partition_id()), "ranked")
    offsets, before = [], start - 1
    for p, n in sorted(tuple(r) for r in ranged.groupBy(part).count().collect()):
        offsets.append((p, before))
        before += n
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    local = F.row_number().over(W.partitionBy(part).orderBy(*order_by)).cast("bigint")
    shifts = literal_table(df.sparkSession, [part, shift], offsets)
    return ranged.join(shifts, part).withColumn(name, local + F.col(shift)).drop(part, shift)


def with_running_total(df: DataFrame, order_by: list[str], amount: str, name: str) -> DataFrame:
    """The sum of ``amount`` over all rows before each one, by ``order_by`` (which must be unique).

    Works like ``with_global_rank``: ranges are written, one sum per range reaches the driver.
    """
    part, shift = "__part", "__shift"
    ranged = materialize(df.repartitionByRange(*order_by).withColumn(part, F.spark_partition_id()), "totals")
    offsets, before = [], 0
    for p, n in sorted(tuple(r) for r in ranged.groupBy(part).agg(F.coalesce(F.sum(amount), F.lit(0))).collect()):
        offsets.append((p, before))
        before += n
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    earlier = F.sum(amount).over(W.partitionBy(part).orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1))
    shifts = literal_table(df.sparkSession, [part, shift], offsets)
    return ranged.join(shifts, part).withColumn(name, (F.coalesce(earlier, F.lit(0)) + F.col(shift)).cast("bigint")).drop(part, shift)
