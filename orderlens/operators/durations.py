"""Elapsed time between two lifecycle events of an order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import in_open_month

# The names of the measured spans and of the quality outcomes.
SHIPPING_TO_DELIVERY = "shipping_to_delivery"
DELIVERY_TO_RETURN = "delivery_to_return"
MISSING_END = "missing_end"
OPEN_END = "incomplete_or_future_end_month"
MISSING_START = "missing_start"
REVERSED = "reversed_timestamps"
VALID = "valid"

SECONDS_PER_DAY = 86400.0

MIDDLE = {"median": 50, "p90": 90}


def event_pairs(orders: DataFrame) -> DataFrame:
    """One row per measured span of an order, from a single scan.

    Delivered orders have a shipping span; returned ones also a return span.
    """
    shipping = F.struct(
        F.lit(SHIPPING_TO_DELIVERY).alias("duration_type"),
        F.col("shipped_at").alias("start_at"),
        F.col("delivered_at").alias("end_at"),
    )
    returning = F.struct(
        F.lit(DELIVERY_TO_RETURN).alias("duration_type"),
        F.col("delivered_at").alias("start_at"),
        F.col("returned_at").alias("end_at"),
    )
    spans = F.when(F.col("status") == "Returned", F.array(shipping, returning)).otherwise(
        F.array(shipping)
    )
    return (
        orders.filter(F.col("status").isin("Complete", "Returned"))
        .select("order_id", F.explode(spans).alias("span"))
        .select("order_id", "span.*")
    )


def classified_durations(orders: DataFrame, as_of: date) -> DataFrame:
    """Event pairs with one quality outcome each and the whole seconds elapsed.

    The outcomes exclude each other in this order. ``elapsed_seconds`` is NULL
    unless the pair is valid.
    """
    outcome = (
        F.when(F.col("end_at").isNull(), MISSING_END)
        .when(in_open_month("end_at", as_of), OPEN_END)
        .when(F.col("start_at").isNull(), MISSING_START)
        .when(F.col("end_at") < F.col("start_at"), REVERSED)
        .otherwise(VALID)
    )
    seconds = F.timestamp_diff("SECOND", F.col("start_at"), F.col("end_at"))
    return (
        event_pairs(orders)
        .withColumn("outcome", outcome)
        .withColumn("elapsed_seconds", F.when(F.col("outcome") == VALID, seconds))
    )
