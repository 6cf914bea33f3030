"""Connected components by alternating star contractions, all in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not its component's least node.

    ``edges`` is a stored table, or a union of some, with the columns ``a`` and
    ``b``. Each round hangs the larger
    neighbours of a node, then its smaller ones, under the least neighbour; the
    number of rounds grows with the logarithm of the nodes. A hub is one row
    after its minimum is taken, and the join with its neighbours may be split.
    """
    stars = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    )
    before = None
    while True:
        both = stars.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(
            stars.select(F.col("root").alias("x"), F.col("node").alias("y"))
        )
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("root"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("node"), "root")
        under = large.groupBy("node").agg(F.min("root").alias("least"))
        moved = (
            large.join(under, "node")
            .filter("root <> least")
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
        )
        stars = materialize(
            moved.unionByName(under.withColumnRenamed("least", "root")).distinct(), "stars"
        )
        if before is not None:
            discard(before)
        before = stars
        if _settled(stars):
            return stars


def _settled(stars: DataFrame) -> bool:
    """Whether every node has one root and no root is a node."""
    one, none = F.lit(1).alias("as_node"), F.lit(0).alias("as_node")
    used = stars.select(F.col("node").alias("x"), one).unionByName(
        stars.select(F.col("root").alias("x"), none)
    )
    per_x = used.groupBy("x").agg(F.sum("as_node").alias("roots"), F.min("as_node").alias("low"))
    odd = (F.col("roots") > 1) | ((F.col("roots") == 1) & (F.col("low") == 0))
    return per_x.agg(F.count_if(odd)).first()[0] == 0
