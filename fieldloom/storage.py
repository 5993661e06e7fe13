"""Written intermediate tables in the folder all executors share.

A lazy plan that is used more than once (a graph loop, a catalog that many
queries read) is written as Parquet and read back.  The files outlive the
executors that wrote them, keep column pruning and filter pushdown, and cut the
lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLANK = "__BLANK__"


class AlreadyThere(RuntimeError):
    """Another writer published under this name first."""

_LOCAL_ROOT: tempfile.TemporaryDirectory | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster it
    would be visible to one machine only, so a missing setting is an error.
    """
    global _LOCAL_ROOT
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.TemporaryDirectory(prefix="fieldloom-", ignore_cleanup_errors=True)
    return _LOCAL_ROOT.name


def clear(spark: SparkSession) -> None:
    """Remove all intermediate tables below the shared folder; call it when no result that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/fieldloom")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(spark: SparkSession, path: str) -> None:
    """Remove one intermediate table whose successor is written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``, sorted; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as one text."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all; its name must be new, so of two writers one fails."""
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target = fs.Path(path)
    draft = fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        fs.FileContext.getFileContext(files.getUri(), conf).rename(draft, files.makeQualified(target), how)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            raise AlreadyThere(path) from None
        raise


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, never overwritten."""
    return f"{shared_root(spark)}/fieldloom/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What a write has shuffled is removed when it ends, not when the driver next collects garbage; the session's setting comes back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def succeed(old: DataFrame, df: DataFrame, label: str) -> DataFrame:
    """Write ``df``, the next round of the written table ``old``, and remove that one; nothing else may read it any more."""
    paths = {file.rpartition("/")[0] for file in old.inputFiles()}
    new = materialize(df, label)
    for path in paths:
        discard(df.sparkSession, path)
    return new


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back.

    With ``partition_by`` the rows are rebalanced first: adaptive execution
    merges small partitions and splits a value that holds a large share of the
    rows, so no single task writes a hot partition alone. Partition folders cannot
    hold the empty text; ``BLANK`` stands for it there.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if partition_by is None:
        df.write.parquet(path)
    else:
        kept = F.when(F.col(partition_by) == "", BLANK).otherwise(F.col(partition_by))
        df.withColumn(partition_by, kept).hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if partition_by is not None:
        back = back.withColumn(partition_by, F.when(F.col(partition_by) == BLANK, "").otherwise(F.col(partition_by)))
    return back.select(*df.columns)
