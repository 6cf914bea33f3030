"""The tables as they stood on an earlier day, told from the times of events."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.sources.tables import RetailTables

# Each state, the event that led to it, and the state before that event.
STEPS = (
    ("Returned", "returned_at", "Complete"),
    ("Complete", "delivered_at", "Shipped"),
    ("Shipped", "shipped_at", "Processing"),
)


def _rows_known(df: DataFrame, day: date) -> DataFrame:
    end = F.lit(day + timedelta(days=1))

    def known(event: str) -> Column:
        return F.when(F.col(event) < end, F.col(event)).alias(event)

    status = F.col("status")
    for state, event, before in STEPS:
        status = F.when((status == state) & (F.col(event) >= end), before).otherwise(status)
    events = {event for _, event, _ in STEPS}
    return df.filter(F.col("created_at").isNull() | (F.col("created_at") < end)).select(
        *[
            known(c) if c in events else status.alias(c) if c == "status" else F.col(c)
            for c in df.columns
        ]
    )


def as_known(tables: RetailTables, day: date) -> RetailTables:
    """Orders and items as they were at the end of ``day``.

    Rows created later are left out, later events are NULL, and the status is
    the one before them. A state without the time of its event, such as
    Cancelled, counts as known; so do rows without a creation time, products
    and customers.
    """
    return RetailTables(
        orders=_rows_known(tables.orders, day),
        order_items=_rows_known(tables.order_items, day),
        products=tables.products,
        users=tables.users,
    )
