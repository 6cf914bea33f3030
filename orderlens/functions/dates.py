"""Month arithmetic and the complete-month boundary."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(as_of: date) -> date:
    return as_of.replace(day=1)


def last_complete_month(as_of: date) -> date:
    return (month_start(as_of) - timedelta(days=1)).replace(day=1)


def month_of(timestamp: str | Column) -> Column:
    """First day of the month of an event."""
    return F.trunc(F.to_date(timestamp), "MONTH")


# Boundaries compare the bare timestamp column with a date literal, so that
# the condition reaches the file scan.
def in_complete_month(timestamp: str, as_of: date) -> Column:
    return F.col(timestamp) < F.lit(month_start(as_of))


def in_open_month(timestamp: str, as_of: date) -> Column:
    """In the as-of month or later."""
    return F.col(timestamp) >= F.lit(month_start(as_of))


def after_day(timestamp: str, as_of: date) -> Column:
    """On a later calendar day than ``as_of``."""
    return F.col(timestamp) >= F.lit(as_of + timedelta(days=1))


def months_between(start: Column, end: Column) -> Column:
    """Calendar-month boundaries crossed from ``start`` to ``end``."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
