"""Connected components of a link table, wholly distributed.

Every vertex holds a parent no larger than itself.  One round takes each
vertex's smallest grandparent among its neighbours, offers it to the vertex and
to the vertex's parent, and shortens the paths; the number of rounds is about
logarithmic in the diameter.  Rounds are written, so lost executors cost one
round at most.  Joins meet two exchanged tables, which lets adaptive execution
split a hub that holds a large share of the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component): for every vertex with a link the smallest id it can reach.

    Null ends and self links are ignored; repeated links count once.  No links: no rows.
    """
    pairs = links.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).where("u <> v")
    edges = materialize(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    state = materialize(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("parent")), "parents")
    total = _total(state)
    while total is not None:
        upper = state.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
        grand = materialize(state.join(upper, "parent").select("id", "parent", "grand"), "grandparents")
        near = edges.join(grand.select(F.col("id").alias("v"), F.col("grand").alias("g")), "v").groupBy("u").agg(F.min("g").alias("g"))
        offers = grand.join(near.withColumnRenamed("u", "id"), "id").select(
            F.explode(F.array(F.struct("id", F.least("g", "grand").alias("to")), F.struct(F.col("parent").alias("id"), F.least("g", "grand").alias("to")))).alias("o")
        )
        state = materialize(offers.select("o.id", "o.to").groupBy("id").agg(F.min("to").alias("parent")), "parents")
        before, total = total, _total(state)
        if total == before:
            break
    return state.select("id", F.col("parent").alias("component"))


def _total(state: DataFrame):
    """Sum of all parents; it falls in every round that changes something."""
    return state.agg(F.sum(F.col("parent").cast("decimal(38,0)"))).first()[0]
