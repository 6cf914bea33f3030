"""The eight reporting views.

Each function takes source frames and the as-of date and returns an unordered
frame. Only complete months before the as-of month are reported.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.dates import (
    in_complete_month,
    last_complete_month,
    month_of,
    months_between,
)
from orderlens.functions.numbers import count_if, money, pct, ratio, ratio2, round2, times
from orderlens.operators.calendar import fill_months
from orderlens.operators.durations import (
    MIDDLE,
    MISSING_START,
    REVERSED,
    SECONDS_PER_DAY,
    VALID,
    classified_durations,
)
from orderlens.operators.hotkeys import join_parents
from orderlens.operators.ordering import (
    approximate_quantiles,
    magnitude,
    quantiles,
    same,
    with_ranks,
)
from orderlens.operators.rows import eligible_orders, recognized_items, with_copies
from orderlens.session import materialize
from orderlens.sources import RetailTables

# Order states and customer segments.
STATUSES = ("Processing", "Shipped", "Complete", "Cancelled", "Returned")
SEGMENTS = ("No completed purchases", "One-time customer", "Repeat customer")


def recognized_by_month(items: DataFrame, as_of: date) -> DataFrame:
    """Orders, items and unrounded revenue per delivery month."""
    sold = recognized_items(items, as_of)
    return sold.groupBy(month_of("delivered_at").alias("revenue_month")).agg(
        F.countDistinct("order_id").alias("completed_orders"),
        F.count("*").alias("completed_items"),
        F.sum(money(items, "sale_price")).alias("recognized_revenue"),
    )


def monthly_revenue(items: DataFrame, as_of: date) -> DataFrame:
    """Recognized revenue per delivery month against the previous observed one.

    Revenue is rounded before months are compared, and months without a
    delivery have no row.
    """
    return revenue_of_months(recognized_by_month(items, as_of))


def revenue_of_months(months: DataFrame) -> DataFrame:
    """``monthly_revenue`` from the rows of ``recognized_by_month``."""
    revenue = F.col("recognized_revenue")
    rounded = months.select(
        "revenue_month",
        "completed_orders",
        "completed_items",
        round2(revenue).alias("recognized_revenue"),
        ratio2(revenue, F.col("completed_orders")).alias("average_order_value"),
    )
    previous = F.lag("recognized_revenue").over(Window.orderBy("revenue_month"))
    return rounded.select(
        "*",
        previous.alias("previous_month_revenue"),
        round2(revenue - previous).alias("revenue_change"),
        pct(revenue - previous, previous).alias("revenue_growth_pct"),
    )


def category_performance(items: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Revenue, profit, rank and share per product category."""
    sold = recognized_items(items, as_of).select(
        "product_id", "order_id", money(items, "sale_price").alias("price")
    )
    priced = with_copies(products, "id", "category", money(products, "cost").alias("cost"))
    joined = join_parents(sold, priced, "product_id", "id").withColumn(
        "profit", F.col("price") - F.col("cost")
    )
    copies = F.col("copies")
    totals = joined.groupBy("category").agg(
        F.countDistinct("order_id").alias("completed_orders"),
        F.sum(copies).alias("completed_items"),
        F.sum(times(joined, "price", copies)).alias("revenue"),
        F.sum(times(joined, "profit", copies)).alias("profit"),
    )
    # From here on there is one row per category.
    revenue, profit = F.col("revenue"), F.col("profit")
    return totals.select(
        "category",
        F.rank().over(Window.orderBy(F.desc("revenue"))).cast("bigint").alias("revenue_rank"),
        "completed_orders",
        "completed_items",
        round2(revenue).alias("recognized_revenue"),
        round2(profit).alias("estimated_gross_profit"),
        pct(profit, revenue).alias("gross_margin_pct"),
        pct(revenue, F.sum("revenue").over(Window.partitionBy())).alias("revenue_share_pct"),
    )


def customer_segments(items: DataFrame, users: DataFrame, as_of: date) -> DataFrame:
    """Registered customers by their number of completed orders."""
    sold = recognized_items(items, as_of)
    buyers = sold.groupBy("user_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum(money(items, "sale_price")).alias("revenue"),
    )
    customers = with_copies(users, "id")
    joined = customers.join(buyers, customers["id"] == buyers["user_id"], "left")
    revenue = times(joined, "revenue", F.col("copies"))
    summary = joined.select(
        F.coalesce(F.col("orders") * F.col("copies"), F.lit(0)).alias("orders"),
        F.coalesce(revenue, F.lit(0)).alias("revenue"),
    )
    segment = (
        F.when(F.col("orders") == 0, SEGMENTS[0])
        .when(F.col("orders") == 1, SEGMENTS[1])
        .otherwise(SEGMENTS[2])
    )
    return (
        summary.groupBy(segment.alias("customer_segment"))
        .agg(
            F.count("*").alias("customers"),
            F.sum("orders").alias("completed_orders"),
            F.sum("revenue").alias("revenue"),
        )
        .select(
            "customer_segment",
            "customers",
            "completed_orders",
            round2(F.col("revenue")).alias("recognized_revenue"),
            ratio2(F.col("completed_orders"), F.col("customers")).alias(
                "average_orders_per_customer"
            ),
            ratio2(F.col("revenue"), F.col("customers")).alias("average_revenue_per_customer"),
        )
    )


def monthly_revenue_growth(items: DataFrame, as_of: date) -> DataFrame:
    """Month-over-month, year-over-year and rolling revenue on a full calendar.

    Months without a delivery are zero rows. Unrounded revenue is compared and
    results are rounded last. Rolling figures are NULL until their window holds
    3 or 12 months.
    """
    return growth_of_months(recognized_by_month(items, as_of))


def growth_of_months(months: DataFrame) -> DataFrame:
    """``monthly_revenue_growth`` from the rows of ``recognized_by_month``."""
    filled = fill_months(months, "revenue_month")
    by_month = Window.orderBy("revenue_month")
    series = filled.select(
        "revenue_month",
        *[
            F.coalesce(F.col(c), F.lit(0)).alias(c)
            for c in ("completed_orders", "completed_items", "recognized_revenue")
        ],
    )
    windowed = series.withColumns(
        {
            "last_month": F.lag("recognized_revenue", 1).over(by_month),
            "last_year": F.lag("recognized_revenue", 12).over(by_month),
            **{
                f"{name}_{n}": expr.over(by_month.rowsBetween(1 - n, Window.currentRow))
                for n in (3, 12)
                for name, expr in (
                    ("months", F.count("*")),
                    ("revenue", F.sum("recognized_revenue")),
                )
            },
        }
    )
    revenue = F.col("recognized_revenue")

    def compared(previous: str, label: str) -> list[Column]:
        value = F.col(previous)
        return [
            round2(revenue - value).alias(f"{label}_revenue_change"),
            pct(revenue - value, value).alias(f"{label}_growth_pct"),
        ]

    def rolling(n: int) -> list[Column]:
        full, total = F.col(f"months_{n}") == n, F.col(f"revenue_{n}")
        return [
            F.when(full, round2(total)).alias(f"rolling_{n}_month_revenue"),
            F.when(full, ratio2(total, F.lit(n))).alias(f"rolling_{n}_month_average_revenue"),
        ]

    return windowed.select(
        "revenue_month",
        "completed_orders",
        "completed_items",
        round2(revenue).alias("recognized_revenue"),
        ratio2(revenue, F.col("completed_orders")).alias("average_order_value"),
        round2(F.col("last_month")).alias("previous_month_revenue"),
        *compared("last_month", "month_over_month"),
        round2(F.col("last_year")).alias("previous_year_revenue"),
        *compared("last_year", "year_over_year"),
        *rolling(3),
        *rolling(12),
    )


def customer_retention_cohorts(items: DataFrame, as_of: date, max_age: int = 12) -> DataFrame:
    """Share of each first-purchase cohort that bought again N months later."""
    active = (
        recognized_items(items, as_of)
        .filter(F.col("user_id").isNotNull())
        .select("user_id", month_of("delivered_at").alias("active_month"))
        .distinct()
    )
    # A customer has at most one row per month here, however many items.
    first = F.min("active_month").over(Window.partitionBy("user_id"))
    age = months_between(F.col("cohort_month"), F.col("active_month"))
    by_age = (
        active.withColumn("cohort_month", first)
        .groupBy("cohort_month", age.alias("age"))
        .agg(F.count("*").alias("customers"))
    )
    # Every customer is active at age 0, so that count is the cohort size. A
    # cohort keeps at most max_age + 1 entries.
    kept = F.when(F.col("age").between(0, max_age), F.struct("age", "customers"))
    cohorts = by_age.groupBy("cohort_month").agg(
        F.map_from_entries(F.collect_list(kept)).alias("by_age"),
        F.max(F.when(F.col("age") == 0, F.col("customers"))).alias("cohort_customers"),
    )
    oldest = F.least(
        F.lit(max_age), months_between(F.col("cohort_month"), F.lit(last_complete_month(as_of)))
    )
    ages = F.when(oldest >= 0, F.sequence(F.lit(0), oldest))
    spine = cohorts.withColumn("age", F.explode(ages)).withColumn(
        "active_customers", F.coalesce(F.try_element_at("by_age", F.col("age")), F.lit(0))
    )
    return spine.select(
        "cohort_month",
        F.col("age").cast("bigint").alias("months_since_first_purchase"),
        F.add_months("cohort_month", F.col("age")).alias("activity_month"),
        "cohort_customers",
        "active_customers",
        pct(F.col("active_customers"), F.col("cohort_customers"))
        .cast("double")
        .alias("retention_pct"),
    )


def _product_totals(items: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Sales per product, collapsed before the join so no product is a hot key."""
    sold = recognized_items(items, as_of).select(
        "product_id", "order_id", money(items, "sale_price").alias("price")
    )
    sales = sold.groupBy("product_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.count("*").alias("items"),
        F.count("price").alias("priced_items"),
        F.sum("price").alias("revenue"),
    )
    priced = with_copies(products, "id", "name", "category", money(products, "cost").alias("cost"))
    joined = sales.join(priced, sales["product_id"] == priced["id"])
    copies = F.col("copies")
    joined = joined.withColumn("priced_cost", times(joined, "cost", F.col("priced_items")))
    joined = joined.withColumn("profit", F.col("revenue") - F.col("priced_cost"))
    return joined.groupBy("id", "name", "category").agg(
        F.max("orders").alias("completed_orders"),
        F.sum(F.col("items") * copies).alias("completed_items"),
        F.sum(times(joined, "revenue", copies)).alias("recognized_revenue"),
        F.sum(times(joined, "cost", F.col("items") * copies)).alias("estimated_product_cost"),
        F.sum(times(joined, "profit", copies)).alias("estimated_gross_profit"),
    )


def _ranked(totals: DataFrame) -> DataFrame:
    keys = ["category", "recognized_revenue"]
    cells = totals.groupBy(*keys).agg(F.count("*").alias("products"))
    cells = cells.withColumn("bucket", magnitude("recognized_revenue"))
    cells = with_ranks(
        cells,
        "recognized_revenue",
        "products",
        "bucket",
        {"overall_revenue_rank": [], "category_revenue_rank": ["category"]},
    )
    ranks = cells.select(
        *[F.col(k).alias(f"cell_{k}") for k in keys],
        "overall_revenue_rank",
        "category_revenue_rank",
    )
    categories = _category_revenue(totals)
    return totals.join(ranks, same(totals, ranks, {k: f"cell_{k}" for k in keys})).join(
        categories, same(totals, categories, {"category": "of_category"})
    )


def _category_revenue(totals: DataFrame) -> DataFrame:
    """Revenue of each category and of all; the window sees one row per category."""
    categories = totals.groupBy(F.col("category").alias("of_category")).agg(
        F.sum("recognized_revenue").alias("category_revenue")
    )
    everything = F.sum("category_revenue").over(Window.partitionBy())
    return categories.withColumn("all_revenue", everything)


def _performance(ranked: DataFrame) -> DataFrame:
    revenue, profit = F.col("recognized_revenue"), F.col("estimated_gross_profit")
    return ranked.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        "overall_revenue_rank",
        "category_revenue_rank",
        "completed_orders",
        "completed_items",
        "recognized_revenue",
        "estimated_product_cost",
        "estimated_gross_profit",
        pct(profit, revenue).alias("estimated_gross_margin_pct"),
        pct(revenue, F.col("all_revenue")).alias("total_revenue_share_pct"),
        pct(revenue, F.col("category_revenue")).alias("category_revenue_share_pct"),
    )


def product_performance(items: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Sales, ranks and shares per sold product; money is left unrounded.

    Products are ranked in ordered buckets of their revenue. Nothing runs before
    the result is read.
    """
    return _performance(_ranked(_product_totals(items, products, as_of)))


def top_products(items: DataFrame, products: DataFrame, as_of: date, n: int = 50) -> DataFrame:
    """The ``n`` best-selling products with rounded money.

    Every product that ranks higher, overall or in its category, is among the
    ``n`` as well, so they are ranked among themselves.
    """
    totals = _product_totals(items, products, as_of)
    best = totals.orderBy(F.desc("recognized_revenue"), "id").limit(n)
    by_revenue = F.desc("recognized_revenue")
    everything, category = Window.partitionBy(), Window.partitionBy("category")
    ranked = best.withColumns(
        {
            "overall_revenue_rank": F.rank().over(everything.orderBy(by_revenue)).cast("bigint"),
            "category_revenue_rank": F.rank().over(category.orderBy(by_revenue)).cast("bigint"),
        }
    )
    categories = _category_revenue(totals)
    joined = ranked.join(categories, same(ranked, categories, {"category": "of_category"}))
    amounts = ("recognized_revenue", "estimated_product_cost", "estimated_gross_profit")
    return _performance(joined).withColumns({c: round2(F.col(c)) for c in amounts})


def status_by_month(orders: DataFrame, as_of: date) -> DataFrame:
    """Orders and orders of each status per month of creation."""
    return (
        eligible_orders(orders, as_of)
        .groupBy(month_of("created_at").alias("created_month"))
        .agg(
            F.count("*").alias("created_orders"),
            *[
                count_if(F.col("status") == s).alias(f"{s.lower()}_orders")
                for s in STATUSES
            ],
        )
    )


def monthly_order_status(orders: DataFrame, as_of: date) -> DataFrame:
    """Current status of the orders created in each month.

    A month without orders counts 0 and has NULL shares.
    """
    return status_of_months(status_by_month(orders, as_of))


def status_of_months(months: DataFrame) -> DataFrame:
    """``monthly_order_status`` from the rows of ``status_by_month``."""
    filled = fill_months(months, "created_month")
    counts = ["created_orders", *[f"{s.lower()}_orders" for s in STATUSES]]

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return filled.select(
        "created_month",
        *[count(c).alias(c) for c in counts],
        (count("processing_orders") + count("shipped_orders")).alias("currently_open_orders"),
        *[
            pct(F.col(f"{s}_orders"), F.col("created_orders"))
            .cast("double")
            .alias(f"current_{s}_share_pct")
            for s in ("cancelled", "returned", "complete")
        ],
    )


def monthly_order_durations(orders: DataFrame, as_of: date, exact: bool = True) -> DataFrame:
    """Delivery and return durations per month of the end event.

    Months without an end event have no row. Equal durations are counted
    together first, so the quantiles are exact and a busy month is never
    gathered in one task: buckets are whole hours. With ``exact=False`` they
    come from a sketch, and only one row per month and task is shuffled.
    """
    keys = ["duration_type", "event_month"]
    cells = (
        classified_durations(orders, as_of)
        .filter(in_complete_month("end_at", as_of))
        .select(
            "duration_type",
            month_of("end_at").alias("event_month"),
            "outcome",
            "elapsed_seconds",
            F.lit(1).alias("orders"),
        )
    )
    if exact:
        cells = cells.groupBy(*keys, "outcome", "elapsed_seconds").agg(
            F.count("*").alias("orders")
        )
    n, outcome, seconds = F.col("orders"), F.col("outcome"), F.col("elapsed_seconds")

    def with_outcome(name: str) -> Column:
        return F.sum(F.when(outcome == name, n).otherwise(0))

    def days(value: str) -> Column:
        return F.col(value) / SECONDS_PER_DAY

    totals = cells.groupBy(*keys).agg(
        F.sum(n).alias("ended_orders"),
        with_outcome(VALID).alias("valid_duration_orders"),
        with_outcome(MISSING_START).alias("missing_start_orders"),
        with_outcome(REVERSED).alias("reversed_timestamp_orders"),
        F.sum(F.when(seconds == 0, n).otherwise(0)).alias("zero_duration_orders"),
        F.sum(seconds * n).alias("seconds"),
        F.max(seconds).alias("longest"),
        *([] if exact else approximate_quantiles("elapsed_seconds", MIDDLE)),
    )
    if exact:
        weighted = cells.withColumns(
            {
                "valid": F.when(outcome == VALID, n).otherwise(0),
                "hour": F.floor(seconds / 3600),
            }
        )
        middle = quantiles(weighted, "elapsed_seconds", "valid", keys, "hour", MIDDLE)
        totals = totals.join(middle, keys, "left")
    return totals.select(
        *keys,
        "ended_orders",
        "valid_duration_orders",
        "missing_start_orders",
        "reversed_timestamp_orders",
        "zero_duration_orders",
        pct(F.col("valid_duration_orders"), F.col("ended_orders"))
        .cast("double")
        .alias("valid_duration_share_pct"),
        days("seconds").alias("total_elapsed_days"),
        round2(ratio(days("seconds"), F.col("valid_duration_orders")))
        .cast("double")
        .alias("average_days"),
        round2(days("median")).cast("double").alias("approximate_median_days"),
        round2(days("p90")).cast("double").alias("approximate_p90_days"),
        round2(days("longest")).cast("double").alias("maximum_days"),
    )


def build_views(tables: RetailTables, as_of: date) -> dict[str, DataFrame]:
    """All eight views by name."""
    t = tables
    return {
        "monthly_revenue": monthly_revenue(t.order_items, as_of),
        "category_performance": category_performance(t.order_items, t.products, as_of),
        "customer_segments": customer_segments(t.order_items, t.users, as_of),
        "monthly_revenue_growth": monthly_revenue_growth(t.order_items, as_of),
        "customer_retention_cohorts": customer_retention_cohorts(t.order_items, as_of),
        "product_performance": product_performance(t.order_items, t.products, as_of),
        "monthly_order_status": monthly_order_status(t.orders, as_of),
        "monthly_order_durations": monthly_order_durations(t.orders, as_of),
    }
