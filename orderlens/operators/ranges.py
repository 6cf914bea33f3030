"""Joins of points with the intervals that hold them, for any bounds.

Every interval has a level: the least power of two that is not shorter than it.
At its level it touches two bins of that width at most, and is listed in both. A
point is listed once for each level that some interval has, in its bin there. A
point and an interval meet in one bin only, so every pair is reported once, and
only the pairs in one bin are compared. Bins of no point or no interval join
nothing; none needs a width that fits the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _level(first: Column, last: Column) -> Column:
    """The least number of bits b such that 2^b is not less than the interval's length."""
    # The digits of last - first in base two: lengths from 2^(b-1) + 1 to 2^b have b.
    digits = F.length(F.bin(last - first))
    return F.when(last == first, 0).otherwise(digits)


def _shifted(number: Column, level: Column) -> Column:
    return F.call_function("shiftright", number, level)


def points_in_intervals(
    points: DataFrame, intervals: DataFrame, point: str, first: str, last: str
) -> DataFrame:
    """All pairs of a point and an interval with first <= point <= last.

    The three columns are whole numbers, such as days or months, whose
    differences fit 64 bits. Rows with a NULL there and intervals that end before
    they begin have no pair. The frames must not share column names.
    """
    shared = {c.lower() for c in points.columns} & {c.lower() for c in intervals.columns}
    if shared:
        raise ValueError(f"both sides have columns named {sorted(shared)}")
    start, end, place = (F.col(c).cast("bigint") for c in (first, last, point))
    level = _level(start, end).cast("int")
    bins = F.array_distinct(F.array(_shifted(start, level), _shifted(end, level)))
    listed = (
        intervals.filter(start <= end)
        .select("*", level.alias("__level"))
        .select("*", F.explode(bins).alias("__bin"))
    )
    # At most one row for each level.
    levels = intervals.filter(start <= end).agg(F.collect_set(level).alias("levels")).scalar()
    at = F.explode(F.coalesce(levels, F.array().cast("array<int>"))).alias("__at")
    dealt = points.filter(place.isNotNull()).select("*", at)
    dealt = dealt.withColumn("__in", _shifted(place, F.col("__at")))
    met = (F.col("__level") == F.col("__at")) & (F.col("__bin") == F.col("__in"))
    return (
        dealt.join(listed, met)
        .filter(place.between(start, end))
        .drop("__level", "__bin", "__at", "__in")
    )
