"""Quantiles of any period from sketches that are stored per month.

A KLL sketch takes some kilobytes, however many values it has seen, and sketches
of parts merge into that of the whole. So a column of sketches per month (and
group) answers for every period without reading a value again. With the default
size the rank of an answer is off by less than ``RANK_ERROR`` of the values, with
a probability of 99 %; merging does not add to that. The exact operators in
``ordering`` remain the default of all reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import month_of

# Size of a sketch: the values it keeps at its largest level.
SIZE = 4096
# Share of the values by which a rank may be off.
RANK_ERROR = 0.002


def monthly_sketches(
    df: DataFrame, time: str, value: str, by: tuple[str, ...] = (), size: int = SIZE
) -> DataFrame:
    """Per month of ``time`` and group: ``values`` that are not NULL and their ``sketch``.

    Rows without a time are left out. One row per month, group and task is
    shuffled.
    """
    number = F.col(value).cast("double")
    return (
        df.filter(F.col(time).isNotNull())
        .groupBy(month_of(time).alias("month"), *by)
        .agg(
            F.count(number).alias("values"),
            F.kll_sketch_agg_double(number, F.lit(size)).alias("sketch"),
        )
    )


def merged(sketches: DataFrame, by: tuple[str | Column, ...] = (), size: int = SIZE) -> DataFrame:
    """The sketches of longer periods or wider groups: ``values`` and ``sketch`` per ``by``."""
    return (
        sketches.filter(F.col("values") > 0)
        .groupBy(*by)
        .agg(
            F.sum("values").alias("values"),
            F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"),
        )
    )


def points(sketches: DataFrame, percents: dict[str, float]) -> DataFrame:
    """The sketches' quantiles as columns in place of the sketches; NULL where there are no values."""
    known = F.col("values") > 0
    return sketches.select(
        *[F.col(f"`{c}`") for c in sketches.columns if c != "sketch"],
        *[
            F.when(
                known, F.kll_sketch_get_quantile_double("sketch", F.lit(percent / 100))
            ).alias(name)
            for name, percent in percents.items()
        ],
    )


def period_points(
    sketches: DataFrame,
    percents: dict[str, float],
    first: Column | None = None,
    last: Column | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Quantiles over the months from ``first`` to ``last``, both included, per group."""
    inside = sketches
    if first is not None:
        inside = inside.filter(F.col("month") >= first)
    if last is not None:
        inside = inside.filter(F.col("month") <= last)
    return points(merged(inside, by), percents)
