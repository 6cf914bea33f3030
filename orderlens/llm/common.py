"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space between words, and the same as a pattern.
SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(column: Column) -> Column:
    """The words between white space; an empty array for blank text."""
    trimmed = F.btrim(column, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    The optimizer moves filters below projections and then repeats their
    expressions, in a lambda even once per element. It does not do so with the
    output of a generator, here of exactly one row.
    """
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    fields = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(fields)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name not yet in ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
