"""Lines of text files with their numbers, and the files that cannot be used.

A file is read in splits by many tasks, so a line does not know its number. Lines
are written once with their split and their place in the task; the lines of each
split are counted, and the counts of the splits before it say where a split
starts. Only one row per split is sorted, no line is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ranking import with_running_total
from ..storage import materialize


def read_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lines, rejects) of all files below ``path``.

    ``lines`` has ``ord``, which numbers all lines from 1 in the order of the files' paths, ``file``,
    ``line_no`` from 1 in each file, and ``line``. ``rejects`` has ``file``, ``reason``, ``lines``
    and ``first_bad``: files without a line, and files of which a line is not UTF-8; such a file
    gives no lines at all, as what it means is not known.
    """
    source = spark.read.option("recursiveFileLookup", "true")
    raw = source.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    held = materialize(raw, "lines")
    valid = F.call_function("is_valid_utf8", F.col("line"))
    splits = held.groupBy("file", "block").agg(F.min("at").alias("start"), F.count("*").alias("n"), F.min(F.when(~valid, F.col("at"))).alias("bad"))
    earlier = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = materialize(splits.withColumn("in_file", earlier), "splits")
    files = splits.groupBy("file").agg(F.sum("n").alias("lines"), F.min(F.col("bad") - F.col("start") + F.col("in_file") + 1).alias("first_bad"))
    listed = source.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    state = listed.join(files, "file", "left")
    reason = F.when(F.col("lines").isNull(), "empty").when(F.col("first_bad").isNotNull(), "not UTF-8")
    rejects = state.select("file", reason.alias("reason"), F.coalesce("lines", F.lit(0)).alias("lines"), "first_bad").filter("reason IS NOT NULL")
    good = splits.join(files.filter("first_bad IS NULL").select("file"), "file", "left_semi")
    placed = with_running_total(good, ["file", "block"], "n", "before").select("file", "block", "start", "in_file", "before")
    step = F.col("at") - F.col("start") + 1
    lines = held.join(placed, ["file", "block"]).select((F.col("before") + step).alias("ord"), "file", (F.col("in_file") + step).alias("line_no"), "line")
    return lines, rejects
