"""Small constant tables as local relations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def _sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[object]]) -> DataFrame:
    """A table of constants with exact statistics.

    The optimizer sees its true size, so it broadcasts the table only while it
    stays below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
    otherwise; no hint is needed.
    """
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")
