"""Queries behind the summary dashboard, on top of the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numbers import ratio


def kpi_recognized_revenue(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.sum("recognized_revenue").alias("recognized_revenue"))


def kpi_completed_orders(monthly: DataFrame) -> DataFrame:
    """Orders summed over months; one delivered in two months counts in both."""
    return monthly.agg(F.sum("completed_orders").alias("completed_orders"))


def kpi_average_order_value(monthly: DataFrame) -> DataFrame:
    """Revenue over orders of all months, not the mean of monthly values."""
    value = ratio(F.sum("recognized_revenue"), F.sum("completed_orders"))
    return monthly.agg(value.alias("average_order_value"))


def kpi_gross_margin(categories: DataFrame) -> DataFrame:
    """Profit over revenue of all categories, as a fraction."""
    value = ratio(F.sum("estimated_gross_profit"), F.sum("recognized_revenue"))
    return categories.agg(value.alias("gross_margin"))


def monthly_revenue_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "revenue_month",
        "recognized_revenue",
        "completed_orders",
        "average_order_value",
        "revenue_growth_pct",
    ).orderBy("revenue_month")


def top_categories(categories: DataFrame, n: int = 10) -> DataFrame:
    """Categories ranked up to ``n``; ties may add more."""
    return categories.filter(F.col("revenue_rank") <= n).orderBy(F.desc("recognized_revenue"))


def segment_distribution(segments: DataFrame) -> DataFrame:
    return segments.orderBy(F.desc("customers"))
