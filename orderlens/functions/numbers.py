"""Money, rounding and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed value: nine fractional digits, the scale of exact money arithmetic.
MONEY_SCALE = 9
# An amount of AMOUNT_DIGITS digits times a count of COUNT_DIGITS digits still
# fits 38 digits, so Spark does not reduce the scale of the product.
AMOUNT_DIGITS = 24
COUNT_DIGITS = 13


def money(df: DataFrame, name: str) -> Column:
    """Column ``name`` as an exact decimal; decimals pass through unchanged."""
    if isinstance(df.schema[name].dataType, DecimalType):
        return F.col(name)
    return F.col(name).cast(DecimalType(AMOUNT_DIGITS, MONEY_SCALE))


def times(df: DataFrame, amount: str, count: Column) -> Column:
    """Exact product of the decimal column ``amount`` and a whole number."""
    scale = df.schema[amount].dataType.scale
    return F.col(amount).cast(DecimalType(AMOUNT_DIGITS, scale)) * count.cast(
        DecimalType(COUNT_DIGITS, 0)
    )


def round2(value: Column) -> Column:
    """Two decimals, halves away from zero, decided on nine exact digits."""
    return F.round(value.cast(DecimalType(38, MONEY_SCALE)), 2)


def ratio(num: Column, den: Column) -> Column:
    """Floating quotient; NULL when the divisor is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio2(num: Column, den: Column) -> Column:
    return round2(ratio(num, den))


def pct(num: Column, den: Column) -> Column:
    """``num`` as a percentage of ``den``, two decimals."""
    return round2(ratio(num, den) * 100.0)


def count_if(condition: Column) -> Column:
    """Rows where the condition is true; NULL conditions do not count."""
    return F.count_if(condition)


def sum_if(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))
