"""Reconciliations of the views with the source and with each other.

Checks take finished view frames, so that several checks can share one stored
copy. Flags are TRUE and mismatch counts are 0 when the views are sound.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import (
    in_complete_month,
    last_complete_month,
    month_of,
    month_start,
    months_between,
)
from orderlens.functions.numbers import (
    count_if,
    money,
    pct,
    ratio2,
    round2,
    sum_if,
    times,
)
from orderlens.operators.calendar import months
from orderlens.operators.durations import SECONDS_PER_DAY, event_pairs
from orderlens.operators.ranges import points_in_intervals
from orderlens.operators.rows import eligible_orders, one_row, recognized_items, with_copies


def _differs(a: Column, b: Column) -> Column:
    """Unequal, with NULL equal to NULL only."""
    return ~a.eqNullSafe(b)


def _beyond(a: Column, b: Column, tolerance: str) -> Column:
    return F.abs(a - b) > F.lit(tolerance).cast("decimal(9,6)")


def _within(a: Column, b: Column, tolerance: str) -> Column:
    return F.abs(a - b) <= F.lit(tolerance).cast("decimal(9,6)")


def _sum2(column: str) -> Column:
    return round2(F.sum(column))


def _equal(a: str, b: str) -> Column:
    return F.col(a) == F.col(b)


# --- revenue views --------------------------------------------------------


def reconcile_reporting_views(
    monthly: DataFrame, categories: DataFrame, segments: DataFrame, as_of: date
) -> DataFrame:
    """Shared orders, items and revenue of the three revenue views.

    Category orders are left out: an order may span categories.
    """
    totals = one_row(
        monthly.agg(
            F.max("revenue_month").alias("latest_reported_month"),
            F.sum("completed_orders").alias("monthly_orders"),
            F.sum("completed_items").alias("monthly_items"),
            _sum2("recognized_revenue").alias("monthly_revenue"),
        ),
        categories.agg(
            F.sum("completed_items").alias("category_items"),
            _sum2("recognized_revenue").alias("category_revenue"),
        ),
        segments.agg(
            F.sum("customers").alias("customer_count"),
            F.sum("completed_orders").alias("customer_orders"),
            _sum2("recognized_revenue").alias("customer_revenue"),
        ),
    )
    return totals.select(
        "latest_reported_month",
        (F.col("latest_reported_month") < F.lit(month_start(as_of))).alias(
            "latest_month_is_complete"
        ),
        "monthly_orders",
        "customer_orders",
        _equal("monthly_orders", "customer_orders").alias("orders_match"),
        "monthly_items",
        "category_items",
        _equal("monthly_items", "category_items").alias("items_match"),
        "monthly_revenue",
        "category_revenue",
        _equal("monthly_revenue", "category_revenue").alias("category_revenue_matches"),
        "customer_revenue",
        _equal("monthly_revenue", "customer_revenue").alias("customer_revenue_matches"),
        "customer_count",
    )


def _calendar_flags(as_of: date) -> list[Column]:
    span = months_between(F.col("first_month"), F.col("latest_month")) + 1
    return [
        _equal("monthly_rows", "unique_months").alias("one_row_per_month"),
        (F.col("monthly_rows") == span).alias("calendar_is_continuous"),
        (F.col("latest_month") < F.lit(month_start(as_of))).alias("latest_month_is_complete"),
    ]


def _calendar_counts(month: str) -> list[Column]:
    return [
        F.count("*").alias("monthly_rows"),
        F.countDistinct(month).alias("unique_months"),
        F.min(month).alias("first_month"),
        F.max(month).alias("latest_month"),
    ]


def growth_grain_check(growth: DataFrame, as_of: date) -> DataFrame:
    """Grain, continuity and NULL positions of the growth view."""
    nulls = {
        "previous_month": "previous_month_revenue",
        "previous_year": "previous_year_revenue",
        "rolling_3": "rolling_3_month_revenue",
        "rolling_12": "rolling_12_month_revenue",
    }
    counted = growth.agg(
        *_calendar_counts("revenue_month"),
        *[count_if(F.col(c).isNull()).alias(f"null_{n}_rows") for n, c in nulls.items()],
    )
    span = months_between(F.col("first_month"), F.col("latest_month")) + 1
    return counted.select(
        "monthly_rows",
        "unique_months",
        "first_month",
        "latest_month",
        span.cast("bigint").alias("expected_calendar_months"),
        *_calendar_flags(as_of),
        *[f"null_{n}_rows" for n in nulls],
    )


def _month_totals(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.sum("completed_orders").alias(f"{label}_completed_orders"),
        F.sum("completed_items").alias(f"{label}_completed_items"),
        _sum2("recognized_revenue").alias(f"{label}_recognized_revenue"),
    )


def growth_vs_monthly(monthly: DataFrame, growth: DataFrame) -> DataFrame:
    """Totals of the growth view against the monthly view."""
    totals = one_row(_month_totals(monthly, "existing"), _month_totals(growth, "growth"))
    flags = {
        "completed_orders": "completed_orders_match",
        "completed_items": "completed_items_match",
        "recognized_revenue": "recognized_revenue_matches",
    }
    return totals.select(
        "*", *[_equal(f"existing_{c}", f"growth_{c}").alias(f) for c, f in flags.items()]
    )


def growth_view_check(monthly: DataFrame, growth: DataFrame, as_of: date) -> DataFrame:
    """Grain and totals of the stored growth view in one row."""
    totals = one_row(
        growth.agg(
            *_calendar_counts("revenue_month"),
            F.sum("completed_orders").alias("completed_orders"),
            F.sum("completed_items").alias("completed_items"),
            _sum2("recognized_revenue").alias("recognized_revenue"),
        ),
        _month_totals(monthly, "existing"),
    )
    return totals.select(
        "monthly_rows",
        "unique_months",
        "first_month",
        "latest_month",
        *_calendar_flags(as_of),
        "completed_orders",
        "completed_items",
        "recognized_revenue",
        _equal("completed_orders", "existing_completed_orders").alias("completed_orders_match"),
        _equal("completed_items", "existing_completed_items").alias("completed_items_match"),
        _equal("recognized_revenue", "existing_recognized_revenue").alias(
            "recognized_revenue_matches"
        ),
    )


def growth_arithmetic_check(growth: DataFrame) -> DataFrame:
    """Recomputed AOV, changes and growth that differ by more than 0.01."""
    revenue = F.col("recognized_revenue")
    checks = [
        count_if(
            _beyond(
                F.col("average_order_value"), ratio2(revenue, F.col("completed_orders")), "0.01"
            )
        ).alias("average_order_value_mismatches")
    ]
    for label, previous in (
        ("month_over_month", F.col("previous_month_revenue")),
        ("year_over_year", F.col("previous_year_revenue")),
    ):
        change = revenue - previous
        for name, value in (
            ("change", _beyond(F.col(f"{label}_revenue_change"), round2(change), "0.01")),
            ("growth", _beyond(F.col(f"{label}_growth_pct"), pct(change, previous), "0.01")),
        ):
            checks.append(
                count_if(previous.isNotNull() & value).alias(f"{label}_{name}_mismatches")
            )
    return growth.agg(*checks)


def rolling_window_check(growth: DataFrame) -> DataFrame:
    """Rolling figures rebuilt from the months in the window of each month.

    A window is an interval of months, joined with the months it holds.
    """
    spans = (3, 12)
    number = F.year("revenue_month") * 12 + F.month("revenue_month")
    months = growth.select(
        number.alias("past_month"), F.col("recognized_revenue").alias("past_revenue")
    )
    windows = growth.select(
        F.col("revenue_month").alias("rebuilt_month"),
        number.alias("last_month"),
        F.explode(F.array(*[F.lit(n) for n in spans])).alias("span"),
    ).withColumn("first_month", F.col("last_month") - F.col("span") + 1)
    held = points_in_intervals(months, windows, "past_month", "first_month", "last_month")
    rebuilt = held.groupBy("rebuilt_month").agg(
        *[count_if(F.col("span") == n).alias(f"months_{n}") for n in spans],
        *[
            round2(F.sum(F.when(F.col("span") == n, F.col("past_revenue")))).alias(f"revenue_{n}")
            for n in spans
        ],
    )
    joined = growth.join(rebuilt, F.col("revenue_month") == F.col("rebuilt_month"))
    checks = []
    for n in spans:
        total = F.col(f"revenue_{n}")
        for name, column, expected in (
            ("revenue", f"rolling_{n}_month_revenue", total),
            ("average", f"rolling_{n}_month_average_revenue", ratio2(total, F.lit(n))),
        ):
            wrong = F.when(
                F.col(f"months_{n}") == n, _beyond(F.col(column), expected, "0.01")
            ).otherwise(F.col(column).isNotNull())
            checks.append(count_if(wrong).alias(f"rolling_{n}_{name}_mismatches"))
    return joined.agg(*checks)


def cohort_start_check(
    items: DataFrame,
    monthly: DataFrame,
    growth: DataFrame,
    first_month: date,
    last_month: date,
) -> DataFrame:
    """Source activity beside both revenue views for chosen months."""
    beyond = F.add_months(F.lit(last_month), 1)
    sold = items.filter(
        (F.col("status") == "Complete")
        & (F.col("delivered_at") >= F.lit(first_month))
        & (F.col("delivered_at") < beyond)
    )
    source = sold.groupBy(month_of("delivered_at").alias("source_month")).agg(
        F.count("*").alias("items"),
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("user_id").alias("buyers"),
        count_if(F.col("user_id").isNull()).alias("missing_users"),
        round2(F.sum(money(items, "sale_price"))).alias("revenue"),
    )
    existing = monthly.select(
        F.col("revenue_month").alias("existing_month"),
        F.col("completed_items").alias("existing_view_completed_items"),
        F.col("recognized_revenue").alias("existing_view_revenue"),
    )
    grown = growth.select(
        F.col("revenue_month").alias("growth_month"),
        F.col("completed_items").alias("growth_view_completed_items"),
        F.col("recognized_revenue").alias("growth_view_revenue"),
    )
    calendar = items.sparkSession.range(1).select(
        F.explode(months(F.lit(first_month), F.lit(last_month))).alias("month")
    )
    return (
        calendar.join(source, F.col("month") == F.col("source_month"), "left")
        .join(existing, F.col("month") == F.col("existing_month"), "left")
        .join(grown, F.col("month") == F.col("growth_month"), "left")
        .select(
            "month",
            F.coalesce("items", F.lit(0)).alias("source_completed_items"),
            F.coalesce("orders", F.lit(0)).alias("source_completed_orders"),
            F.coalesce("buyers", F.lit(0)).alias("source_unique_buyers"),
            F.coalesce("missing_users", F.lit(0)).alias("source_missing_user_ids"),
            F.coalesce("revenue", F.lit(0)).alias("source_recognized_revenue"),
            "existing_view_completed_items",
            "existing_view_revenue",
            "growth_view_completed_items",
            "growth_view_revenue",
        )
        .orderBy("month")
    )


# --- retention ------------------------------------------------------------


def _expected_ages(cohort_month: Column, as_of: date, max_age: int) -> Column:
    last = F.lit(last_complete_month(as_of))
    return F.least(F.lit(max_age), months_between(cohort_month, last)) + 1


def _retention_counts(retention: DataFrame, as_of: date, max_age: int) -> DataFrame:
    age = F.col("months_since_first_purchase")
    active, size = F.col("active_customers"), F.col("cohort_customers")
    start = age == 0
    return retention.agg(
        F.count("*").alias("cohort_month_rows"),
        F.countDistinct("cohort_month").alias("cohort_months"),
        sum_if(start, size).alias("cohort_size_total"),
        count_if(start).alias("month_zero_rows"),
        count_if((age > 0) & (active > 0)).alias("nonzero_return_rows"),
        (F.count("*") - F.countDistinct("cohort_month", age)).alias("duplicate_cohort_age_rows"),
        count_if(start & (active != size)).alias("month_zero_customer_mismatches"),
        count_if(start & (F.col("retention_pct") != 100)).alias(
            "month_zero_retention_mismatches"
        ),
        count_if((active > size) | (active < 0)).alias("invalid_active_customer_rows"),
        count_if(~age.between(0, max_age)).alias("invalid_cohort_age_rows"),
        count_if(
            F.col("activity_month") != F.add_months("cohort_month", age.cast("int"))
        ).alias("activity_month_mismatches"),
        count_if(F.col("activity_month") >= F.lit(month_start(as_of))).alias(
            "incomplete_or_future_month_rows"
        ),
        count_if(F.col("retention_pct") != pct(active, size).cast("double")).alias(
            "retention_calculation_mismatches"
        ),
        F.sum(F.when(start, _expected_ages(F.col("cohort_month"), as_of, max_age))).alias(
            "rows_expected_by_view"
        ),
    )


def retention_check(
    retention: DataFrame, items: DataFrame, as_of: date, max_age: int = 12
) -> DataFrame:
    """Retention against cohorts rebuilt from the source."""
    first_months = (
        recognized_items(items, as_of)
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min(month_of("delivered_at")).alias("cohort_month"))
    )
    cohorts = first_months.groupBy("cohort_month").agg(F.count("*").alias("buyers"))
    changing = retention.groupBy("cohort_month").agg(
        (F.min("cohort_customers") != F.max("cohort_customers")).alias("changing")
    )
    totals = one_row(
        _retention_counts(retention, as_of, max_age),
        cohorts.agg(
            F.coalesce(F.sum("buyers"), F.lit(0)).alias("source_unique_buyers"),
            F.sum(_expected_ages(F.col("cohort_month"), as_of, max_age)).alias("expected_rows"),
        ),
        changing.agg(count_if(F.col("changing")).alias("cohorts_with_changing_size")),
    )
    return totals.select(
        "cohort_month_rows",
        "cohort_months",
        "source_unique_buyers",
        "cohort_size_total",
        "month_zero_rows",
        "nonzero_return_rows",
        _equal("cohort_month_rows", "expected_rows").alias("expected_spine_rows_match"),
        _equal("month_zero_rows", "cohort_months").alias("one_month_zero_row_per_cohort"),
        _equal("cohort_size_total", "source_unique_buyers").alias("cohort_sizes_match_buyers"),
        "duplicate_cohort_age_rows",
        "month_zero_customer_mismatches",
        "month_zero_retention_mismatches",
        "invalid_active_customer_rows",
        "invalid_cohort_age_rows",
        "activity_month_mismatches",
        "incomplete_or_future_month_rows",
        "retention_calculation_mismatches",
        "cohorts_with_changing_size",
    )


def retention_view_check(
    retention: DataFrame, items: DataFrame, as_of: date, max_age: int = 12
) -> DataFrame:
    """The stored retention view against the number of source buyers."""
    buyers = recognized_items(items, as_of).agg(
        F.countDistinct("user_id").alias("source_unique_buyers")
    )
    return one_row(_retention_counts(retention, as_of, max_age), buyers).select(
        "cohort_month_rows",
        "cohort_months",
        "cohort_size_total",
        "source_unique_buyers",
        _equal("cohort_month_rows", "rows_expected_by_view").alias("expected_rows_match"),
        _equal("month_zero_rows", "cohort_months").alias("one_month_zero_row_per_cohort"),
        _equal("cohort_size_total", "source_unique_buyers").alias("cohort_sizes_match_buyers"),
        "duplicate_cohort_age_rows",
        "month_zero_customer_mismatches",
        "month_zero_retention_mismatches",
        "invalid_active_customer_rows",
        "invalid_cohort_age_rows",
        "incomplete_or_future_month_rows",
        "retention_calculation_mismatches",
    )


# --- products -------------------------------------------------------------


def product_foundation_reconcile(
    foundation: DataFrame, monthly: DataFrame, categories: DataFrame
) -> DataFrame:
    """Product foundation beside the monthly and category views."""
    totals = one_row(
        foundation,
        monthly.agg(
            F.sum("completed_items").alias("monthly_view_items"),
            _sum2("recognized_revenue").alias("monthly_view_revenue"),
        ),
        categories.agg(
            F.sum("completed_items").alias("category_view_items"),
            _sum2("recognized_revenue").alias("category_view_revenue"),
            _sum2("estimated_gross_profit").alias("category_view_estimated_gross_profit"),
        ),
    )
    rows, revenue = "completed_item_rows", F.col("source_recognized_revenue")
    return totals.select(
        "*",
        _equal(rows, "unique_completed_item_ids").alias("one_row_per_item"),
        (
            _equal(rows, "monthly_view_items")
            & _within(revenue, F.col("monthly_view_revenue"), "0.05")
        ).alias("monthly_view_matches_source"),
        (
            _equal(rows, "category_view_items")
            & _within(revenue, F.col("category_view_revenue"), "0.05")
            & _within(
                F.col("source_estimated_gross_profit"),
                F.col("category_view_estimated_gross_profit"),
                "0.05",
            )
        ).alias("category_view_matches_source"),
    )


def _sales_by_product(items: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Items, revenue and profit per product and category, collapsed before the join."""
    sold = recognized_items(items, as_of).select(
        "product_id", money(items, "sale_price").alias("price")
    )
    sales = sold.groupBy("product_id").agg(
        F.count("*").alias("rows"),
        F.count("price").alias("priced_rows"),
        F.sum("price").alias("revenue"),
    )
    costs = with_copies(
        products,
        F.col("id").alias("known_product"),
        "category",
        money(products, "cost").alias("cost"),
    )
    joined = sales.join(costs, sales["product_id"] == costs["known_product"])
    joined = joined.withColumn(
        "profit", F.col("revenue") - times(joined, "cost", F.col("priced_rows"))
    )
    copies = F.col("copies")
    return joined.groupBy("product_id", "category").agg(
        F.sum(F.col("rows") * copies).alias("completed_items"),
        F.sum(times(joined, "revenue", copies)).alias("recognized_revenue"),
        F.sum(times(joined, "profit", copies)).alias("estimated_gross_profit"),
    )


def _product_source(items: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Totals over the item-product inner join, by item rather than by product."""
    sold = recognized_items(items, as_of).select(
        "product_id", money(items, "sale_price").alias("price")
    )
    costs = with_copies(
        products, F.col("id").alias("known_product"), money(products, "cost").alias("cost")
    )
    joined = sold.join(costs, sold["product_id"] == costs["known_product"]).withColumn(
        "profit", F.col("price") - F.col("cost")
    )
    copies = F.col("copies")
    return joined.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("source_items"),
        F.countDistinct("product_id").alias("source_products"),
        round2(F.sum(times(joined, "price", copies))).alias("source_revenue"),
        round2(F.sum(times(joined, "profit", copies))).alias("source_gross_profit"),
    )


def _category_comparison(by_product: DataFrame, categories: DataFrame) -> DataFrame:
    ours = by_product.groupBy(F.col("category").alias("product_category")).agg(
        F.sum("completed_items").alias("items"),
        F.sum("recognized_revenue").alias("revenue"),
        F.sum("estimated_gross_profit").alias("profit"),
    )
    theirs = categories.select(
        F.col("category").alias("view_category"),
        "completed_items",
        "recognized_revenue",
        "estimated_gross_profit",
    )
    # A NULL category never equals another one, so it counts as a mismatch.
    joined = ours.join(theirs, F.col("product_category") == F.col("view_category"), "full")
    mismatch = (
        F.col("product_category").isNull()
        | F.col("view_category").isNull()
        | (F.col("items") != F.col("completed_items"))
        | _beyond(F.col("revenue"), F.col("recognized_revenue"), "0.01")
        | _beyond(F.col("profit"), F.col("estimated_gross_profit"), "0.01")
    )
    return joined.agg(
        F.count("*").alias("categories_compared"), count_if(mismatch).alias("category_mismatches")
    )


def _product_sums() -> list[Column]:
    return [
        F.count("*").alias("product_rows"),
        F.countDistinct("product_id").alias("unique_products"),
        F.sum("completed_items").alias("product_items"),
        _sum2("recognized_revenue").alias("product_revenue"),
        _sum2("estimated_gross_profit").alias("product_gross_profit"),
    ]


def _product_verdict(totals: DataFrame, match_flag: str, extra: tuple[str, ...] = ()) -> DataFrame:
    matches = (
        _equal("product_rows", "source_products")
        & _equal("product_items", "source_items")
        & _equal("product_revenue", "source_revenue")
        & _equal("product_gross_profit", "source_gross_profit")
    )
    return totals.select(
        "product_rows",
        "unique_products",
        "source_products",
        "product_items",
        "source_items",
        "product_revenue",
        "source_revenue",
        "product_gross_profit",
        "source_gross_profit",
        *extra,
        "categories_compared",
        "category_mismatches",
        _equal("product_rows", "unique_products").alias("one_row_per_product"),
        matches.alias(match_flag),
        (F.col("category_mismatches") == 0).alias("categories_match_existing_view"),
    )


def product_reconcile(
    items: DataFrame, products: DataFrame, categories: DataFrame, as_of: date
) -> DataFrame:
    """Product sales rebuilt from the source, against item totals and categories."""
    by_product = _sales_by_product(items, products, as_of)
    totals = one_row(
        by_product.agg(*_product_sums()),
        _product_source(items, products, as_of),
        _category_comparison(by_product, categories),
    )
    return _product_verdict(totals, "product_totals_match_source")


def product_view_reconcile(
    performance: DataFrame,
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    as_of: date,
) -> DataFrame:
    """The stored product view against item totals and categories."""
    missing = (
        F.col("product_id").isNull() | F.col("product_name").isNull() | F.col("category").isNull()
    )
    bad_rank = (F.col("overall_revenue_rank") < 1) | (F.col("category_revenue_rank") < 1)
    totals = one_row(
        performance.agg(
            *_product_sums(),
            count_if(missing).alias("missing_product_attributes"),
            count_if(bad_rank).alias("invalid_ranks"),
        ),
        _product_source(items, products, as_of),
        _category_comparison(performance, categories),
    )
    return _product_verdict(
        totals, "product_view_matches_source", ("missing_product_attributes", "invalid_ranks")
    )


# --- order operations -----------------------------------------------------


def status_check(status: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Monthly order status against its own parts and the source total."""
    parts = ["processing", "shipped", "complete", "cancelled", "returned"]
    created = F.col("created_orders")
    known = sum((F.col(f"{p}_orders") for p in parts), F.lit(0))
    still_open = F.col("processing_orders") + F.col("shipped_orders")
    counted = status.agg(
        *_calendar_counts("created_month"),
        F.sum(created).alias("monthly_order_total"),
        count_if(F.col("created_month") >= F.lit(month_start(as_of))).alias(
            "incomplete_or_future_months"
        ),
        count_if(created != known).alias("status_count_mismatches"),
        count_if(F.col("currently_open_orders") != still_open).alias("open_count_mismatches"),
        *[
            count_if(
                _differs(
                    F.col(f"current_{p}_share_pct"),
                    pct(F.col(f"{p}_orders"), created).cast("double"),
                )
            ).alias(f"{p}_share_mismatches")
            for p in ("cancelled", "returned", "complete")
        ],
    )
    source = eligible_orders(orders, as_of).agg(F.count("*").alias("source_order_total"))
    one_per_month, continuous, _ = _calendar_flags(as_of)
    return one_row(counted, source).select(
        "*",
        one_per_month,
        continuous,
        _equal("monthly_order_total", "source_order_total").alias("orders_match_source"),
    )


def duration_check(durations: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Monthly durations against sums rebuilt from the source, per duration type."""
    start, end = F.col("start_at"), F.col("end_at")
    in_order = start <= end
    seconds = F.when(in_order, F.timestamp_diff("SECOND", start, end))
    source = (
        event_pairs(orders)
        .filter(in_complete_month("end_at", as_of))
        .groupBy(
            F.col("duration_type").alias("source_type"),
            month_of("end_at").alias("source_month"),
        )
        .agg(
            F.count("*").alias("source_ended"),
            count_if(in_order).alias("source_valid"),
            (F.sum(seconds) / SECONDS_PER_DAY).alias("source_days"),
        )
    )
    joined = durations.join(
        source,
        (F.col("duration_type") == F.col("source_type"))
        & (F.col("event_month") == F.col("source_month")),
        "full",
    ).withColumn("compared_type", F.coalesce("duration_type", "source_type"))

    month, ended = F.col("event_month"), F.col("ended_orders")
    valid = F.col("valid_duration_orders")
    zero, average = F.col("zero_duration_orders"), F.col("average_days")
    median, p90 = F.col("approximate_median_days"), F.col("approximate_p90_days")
    longest, total = F.col("maximum_days"), F.col("total_elapsed_days")
    summaries = (average, median, p90, longest)
    rebuilt = F.col("source_days")
    out_of_bounds = (
        median.isNull()
        | p90.isNull()
        | longest.isNull()
        | (median < 0)
        | (p90 < median)
        | (longest < p90)
        | (average < 0)
        | (average > longest)
    )
    any_summary = sum((c.isNotNull().cast("int") for c in summaries), F.lit(0)) > 0
    return (
        joined.groupBy(F.col("compared_type").alias("duration_type"))
        .agg(
            F.count("*").alias("compared_month_rows"),
            F.countDistinct(month).alias("unique_output_months"),
            F.min(month).alias("first_event_month"),
            F.max(month).alias("latest_event_month"),
            F.sum(valid).alias("output_valid_orders"),
            F.sum("source_valid").alias("source_valid_orders"),
            count_if(month.isNull() | F.col("source_month").isNull()).alias(
                "missing_or_extra_months"
            ),
            (F.count("*") - F.countDistinct(month)).alias("duplicate_or_missing_month_rows"),
            count_if(month >= F.lit(month_start(as_of))).alias("incomplete_or_future_months"),
            count_if(
                _differs(ended, F.col("source_ended")) | _differs(valid, F.col("source_valid"))
            ).alias("source_count_mismatches"),
            count_if(
                _differs(
                    ended,
                    valid + F.col("missing_start_orders") + F.col("reversed_timestamp_orders"),
                )
            ).alias("accounting_mismatches"),
            count_if((zero < 0) | (zero > valid)).alias("invalid_zero_counts"),
            count_if(
                _differs(F.col("valid_duration_share_pct"), pct(valid, ended).cast("double"))
            ).alias("coverage_mismatches"),
            count_if(_differs(average, ratio2(total, valid).cast("double"))).alias(
                "average_mismatches"
            ),
            count_if(
                (total.isNull() != rebuilt.isNull()) | (F.abs(total - rebuilt) > 0.000001)
            ).alias("elapsed_total_mismatches"),
            count_if(
                ((valid > 0) & out_of_bounds) | ((valid == 0) & any_summary)
            ).alias("invalid_duration_summary_rows"),
        )
        .orderBy("duration_type")
    )
