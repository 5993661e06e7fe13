"""Session settings used by the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "fieldloom", **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "1048576")
        .config("spark.fieldloom.scan.tasks", str(cpus))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
