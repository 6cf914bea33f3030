"""Continuous month calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def months(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``."""
    return F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))


def fill_months(df: DataFrame, month: str) -> DataFrame:
    """One row per calendar month between the first and the last of ``df``.

    Each observed month also produces the empty months up to the next observed
    one, so the input is evaluated once and nothing is joined. Other columns of
    an empty month are NULL and ``observed`` is false. The window sees one row
    per month.
    """
    following = F.lead(month).over(Window.orderBy(month))
    last = F.coalesce(F.add_months(following, -1), F.col(month))
    others = [c for c in df.columns if c != month]
    spine = df.withColumn("until", last).withColumn(
        "spine_month", F.explode(months(F.col(month), F.col("until")))
    )
    observed = F.col("spine_month") == F.col(month)
    return spine.select(
        F.col("spine_month").alias(month),
        *[F.when(observed, F.col(c)).alias(c) for c in others],
        observed.alias("observed"),
    )
