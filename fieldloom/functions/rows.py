"""Turning computed lists into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LIST = "__list"


def explode_list(df: DataFrame, keep: list[str], items: Column, *names: str, position: bool = False) -> DataFrame:
    """One row per element of a costly list; NULL elements give no row.

    The list is computed by a projection of its own, in generated code, and the
    outer form keeps the optimizer from adding a ``size > 0`` filter below it,
    which would compute the list a second time.
    """
    listed = df.select(*keep, items.alias(_LIST))
    explode = F.posexplode_outer if position else F.explode_outer
    return listed.select(*keep, explode(_LIST).alias(*names)).filter(F.col(names[-1]).isNotNull())
