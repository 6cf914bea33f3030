"""Exact ranks and quantiles without sorting a whole group in one task.

Values are first collapsed to distinct values with a weight (how many rows
carry them), so a value shared by many rows is one row here. Distinct values
are dealt by range into ordered buckets: bucket totals give the weight before
each bucket, and a running sum inside the bucket gives the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> Column:
    """Join condition on key pairs in which NULL equals NULL."""
    pairs = [left[a].eqNullSafe(right[b]) for a, b in keys.items()]
    return reduce(lambda x, y: x & y, pairs)


def _offsets(cells: DataFrame, weight: str, by: list[str], bucket: str) -> DataFrame:
    """Per bucket: weight inside, weight in the buckets before, group total."""
    keys = [*by, bucket]
    inside = cells.groupBy(*keys).agg(F.sum(weight).alias("inside"))
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return inside.select(
        *[F.col(k).alias(f"offset_{k}") for k in keys],
        "inside",
        F.coalesce(F.sum("inside").over(earlier), F.lit(0)).alias("below"),
        F.sum("inside").over(Window.partitionBy(*by)).alias("total"),
    )


def _at_or_below(
    cells: DataFrame, offsets: DataFrame, value: str, weight: str, by: list[str], bucket: str
) -> DataFrame:
    keys = [*by, bucket]
    running = (
        Window.partitionBy(*keys)
        .orderBy(value)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = cells.join(offsets, same(cells, offsets, {k: f"offset_{k}" for k in keys}))
    return joined.withColumn("at_or_below", F.col("below") + F.sum(weight).over(running))


def with_ranks(
    cells: DataFrame, value: str, weight: str, bucket: str, names: dict[str, list[str]]
) -> DataFrame:
    """Add descending ranks of each value, ties sharing the best place.

    ``names`` maps a rank column to the columns it is ranked within. ``cells``
    holds distinct values with their weight; ``bucket`` must grow with ``value``.
    """
    ranked = cells
    for name, by in names.items():
        offsets = _offsets(cells, weight, by, bucket)
        placed = _at_or_below(ranked, offsets, value, weight, by, bucket)
        rank = (F.col("total") - F.col("at_or_below") + 1).cast("bigint")
        ranked = placed.select(*ranked.columns, rank.alias(name))
    return ranked


def quantiles(
    cells: DataFrame,
    value: str,
    weight: str,
    by: list[str],
    bucket: str,
    percents: dict[str, int],
) -> DataFrame:
    """Smallest value covering each percentage of the weight, per ``by`` group.

    Only the buckets that hold a wanted position are read value by value. A
    group without weight has no row. NULL values must have no weight.
    """
    offsets = _offsets(cells, weight, by, bucket)
    needed = {
        name: F.greatest(F.col("total") * percent, F.lit(1)) for name, percent in percents.items()
    }
    through = F.col("below") + F.col("inside")
    holds = [(F.col("below") * 100 < n) & (through * 100 >= n) for n in needed.values()]
    wanted = offsets.filter(reduce(lambda a, b: a | b, holds))
    placed = _at_or_below(cells, wanted, value, weight, by, bucket)
    return placed.groupBy(*by).agg(
        *[
            F.min(F.when(F.col("at_or_below") * 100 >= n, F.col(value))).alias(name)
            for name, n in needed.items()
        ]
    )


def approximate_quantiles(value: str, percents: dict[str, int]) -> list[Column]:
    """Aggregates that estimate the quantiles from a sketch, within 0.01 % of the rank."""
    return [
        F.percentile_approx(value, percent / 100, 10_000).alias(name)
        for name, percent in percents.items()
    ]


# Buckets to each doubling of a value, and more than the buckets below one.
STEPS = 4096
BELOW_ONE = 1100 * STEPS


def magnitude(value: str) -> Column:
    """An ordered bucket of a number, 4096 to each doubling of its size.

    Values of one bucket differ by less than 0.02 %, so buckets follow the values
    wherever they lie, and nothing has to be known of them before. NULL is in
    the lowest. The logarithm of a larger number is not smaller, so no two
    values are in the wrong order.
    """
    number = F.col(value).cast("double")
    size = (F.floor(F.log2(F.abs(number)) * STEPS) + BELOW_ONE).cast("bigint")
    return (
        F.when(number.isNull(), -4 * BELOW_ONE)
        .when(number == 0, 0)
        .when(number < 0, -size)
        .otherwise(size)
    )
