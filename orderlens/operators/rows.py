"""Row selections, copy counting and one-row assembly."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import in_complete_month


def recognized_items(items: DataFrame, as_of: date) -> DataFrame:
    """Completed items delivered before the as-of month."""
    return items.filter(
        (F.col("status") == "Complete") & in_complete_month("delivered_at", as_of)
    )


def eligible_orders(orders: DataFrame, as_of: date) -> DataFrame:
    """Orders created before the as-of month."""
    return orders.filter(in_complete_month("created_at", as_of))


def with_copies(df: DataFrame, *columns) -> DataFrame:
    """Distinct rows of ``columns`` with the number of identical ``copies``.

    Joining against this instead of the table itself gives the same totals
    without building every pair of a repeated key.
    """
    return df.groupBy(*columns).agg(F.count("*").alias("copies"))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames side by side, without a join."""
    names = [c.lower() for frame in frames for c in frame.columns]
    if len(names) != len(set(names)):
        raise ValueError("one-row frames share a column name")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
