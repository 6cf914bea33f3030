"""Monthly views that are kept up to date month by month.

The state of a view are its rows per month before months are compared with one
another: sums and counts that depend on the rows of that month alone. It does
not depend on the as-of date, which only selects months when a view is read. A
refresh computes the months anew that new, changed or removed rows touch and
replaces just their partitions; from the source it asks for the times of those
months only. The views are then made from the state, some rows a month.

A month that has lost its last row is written with a count of zero, which no
reader sees. A refresh that broke off is repeated with the same months.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.dates import month_of, month_start
from orderlens.plans import views
from orderlens.sources import RetailTables

# Later than every event: the state holds all months.
FOREVER = date(9999, 12, 31)
PARTITION = "month_key"


@dataclass(frozen=True)
class State:
    """Rows of one view per month: what they are made of and how."""

    source: str
    times: tuple[str, ...]
    month: str
    counted: str
    build: Callable[[DataFrame, date], DataFrame]


STATES = {
    "revenue": State(
        "order_items",
        ("delivered_at",),
        "revenue_month",
        "completed_items",
        views.recognized_by_month,
    ),
    "status": State(
        "orders", ("created_at",), "created_month", "created_orders", views.status_by_month
    ),
    "durations": State(
        "orders",
        ("delivered_at", "returned_at"),
        "event_month",
        "ended_orders",
        views.monthly_order_durations,
    ),
}

# The views that are made from each state.
VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "monthly_revenue": ("revenue", views.revenue_of_months),
    "monthly_revenue_growth": ("revenue", views.growth_of_months),
    "monthly_order_status": ("status", views.status_of_months),
    "monthly_order_durations": ("durations", lambda months: months),
}


def months_touched(changed: RetailTables | dict[str, DataFrame]) -> dict[str, list[date]]:
    """The months of every state that changed rows belong to.

    ``changed`` has the new rows and, of rows that were changed or removed, the
    former ones as well. A list is as long as the calendar at most.
    """
    frames = changed if isinstance(changed, dict) else changed.named()
    touched = {}
    for name, state in STATES.items():
        if state.source not in frames:
            touched[name] = []
            continue
        months = F.explode(F.array(*[month_of(t) for t in state.times]))
        rows = frames[state.source].select(months.alias("month")).distinct()
        touched[name] = sorted(r["month"] for r in rows.filter("month IS NOT NULL").collect())
    return touched


def _next(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def in_months(times: Iterable[str], months: list[date]) -> Column:
    """Rows of which a time is in one of the months, as ranges that reach the scan."""
    ranges: list[list[date]] = []
    for month in sorted(set(months)):
        if ranges and ranges[-1][1] == month:
            ranges[-1][1] = _next(month)
        else:
            ranges.append([month, _next(month)])
    conditions = [
        (F.col(t) >= F.lit(first)) & (F.col(t) < F.lit(end))
        for t in times
        for first, end in ranges
    ]
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


class MonthlyState:
    """The stored states of the monthly views in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _write(self, name: str, rows: DataFrame) -> None:
        keyed = rows.withColumn(PARTITION, F.date_format(STATES[name].month, "yyyy-MM"))
        (
            keyed.write.option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy(PARTITION)
            .parquet(self._path(name))
        )

    def rebuild(self, tables: RetailTables) -> None:
        """Compute the states of all months into an empty folder."""
        for name, state in STATES.items():
            rows = state.build(getattr(tables, state.source), FOREVER)
            # The types of the state, also where there are no rows.
            types = rows.withColumn(PARTITION, F.lit(""))
            types.limit(0).coalesce(1).write.mode("overwrite").parquet(self._path(f"{name}-types"))
            self._write(name, rows)

    def refresh(self, tables: RetailTables, touched: dict[str, list[date]]) -> None:
        """Compute the touched months of each state again and replace them."""
        for name, months in touched.items():
            if months:
                self._write(name, self.recomputed(name, tables, months))

    def recomputed(self, name: str, tables: RetailTables, months: list[date]) -> DataFrame:
        """The rows of these months as the source has them now."""
        state = STATES[name]
        source = getattr(tables, state.source)
        rows = state.build(source.filter(in_months(state.times, months)), FOREVER)
        wanted = F.col(state.month).isin(months)
        empty = self.spark.createDataFrame([(m,) for m in months], f"{state.month} date")
        # A month without a row left stays as one that counts nothing.
        gone = empty.join(rows.filter(wanted).select(state.month), state.month, "left_anti")
        return rows.filter(wanted).unionByName(
            gone.withColumn(state.counted, F.lit(0).cast("bigint")), allowMissingColumns=True
        )

    def months(self, name: str, as_of: date) -> DataFrame:
        """The rows of a state for the complete months before the as-of month."""
        state = STATES[name]
        types = self.spark.read.parquet(self._path(f"{name}-types")).schema
        rows = self.spark.read.schema(types).parquet(self._path(name))
        complete = rows.filter(F.col(PARTITION) < month_start(as_of).strftime("%Y-%m"))
        return complete.filter(F.col(state.counted) > 0).drop(PARTITION)

    def views(self, as_of: date) -> dict[str, DataFrame]:
        """The monthly views from their states."""
        return {name: make(self.months(state, as_of)) for name, (state, make) in VIEWS.items()}
