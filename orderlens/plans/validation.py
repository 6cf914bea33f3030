"""All checks in one list, and comparisons between stored runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.rows import recognized_items
from orderlens.plans import audits, checks
from orderlens.plans.views import build_views
from orderlens.session import materialize
from orderlens.sources import RetailTables

Views = dict[str, DataFrame]

# What is added up per view to tell two runs apart.
VIEW_TOTALS = {
    "monthly_revenue": ("completed_orders", "completed_items", "recognized_revenue"),
    "category_performance": ("completed_items", "recognized_revenue", "estimated_gross_profit"),
    "customer_segments": ("customers", "completed_orders", "recognized_revenue"),
    "monthly_revenue_growth": ("completed_orders", "completed_items", "recognized_revenue"),
    "customer_retention_cohorts": ("cohort_customers", "active_customers"),
    "product_performance": ("completed_items", "recognized_revenue", "estimated_gross_profit"),
    "monthly_order_status": ("created_orders", "currently_open_orders"),
    "monthly_order_durations": ("ended_orders", "valid_duration_orders"),
}


# What the views and checks read of an item.
ITEM_COLUMNS = ("id", "order_id", "user_id", "product_id", "delivered_at", "sale_price")


def pin_items(
    items: DataFrame, as_of: date, columns: tuple[str, ...] = ITEM_COLUMNS
) -> DataFrame:
    """Store some columns of the recognized items once.

    All parts of a check then see the same rows of a changing source, and the
    work of reading them is done once. Reports on recognized items give the
    same result on the stored rows as on the whole table.
    """
    kept = dict.fromkeys(("status", "delivered_at", *columns))
    return materialize(recognized_items(items, as_of).select(*kept), "recognized-items")


def pin_tables(tables: RetailTables, as_of: date) -> RetailTables:
    """Store everything the views and checks read, as of one moment."""
    events = [f"{event}_at" for event in audits.EVENTS]
    orders = tables.orders.select("order_id", "user_id", "status", *events)
    return RetailTables(
        orders=materialize(orders, "orders"),
        order_items=pin_items(tables.order_items, as_of),
        products=materialize(tables.products, "products"),
        users=materialize(tables.users.select("id"), "users"),
    )


def pin_views(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Store the views, so that all checks read each of them from one result."""
    return {name: materialize(df, f"view-{name}") for name, df in views.items()}


@dataclass(frozen=True)
class Check:
    """A check with the rules it states: counts that have to be 0, flags that have to be true."""

    run: Callable[[RetailTables, Views, date], DataFrame]
    zero: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()


# The names of the rules.
CHECKS = {
    "reporting_views": Check(
        lambda t, v, day: checks.reconcile_reporting_views(
            v["monthly_revenue"], v["category_performance"], v["customer_segments"], day
        ),
        flags=(
            "latest_month_is_complete",
            "orders_match",
            "items_match",
            "category_revenue_matches",
            "customer_revenue_matches",
        ),
    ),
    "growth_grain": Check(
        lambda t, v, day: checks.growth_grain_check(v["monthly_revenue_growth"], day),
        flags=("one_row_per_month", "calendar_is_continuous", "latest_month_is_complete"),
    ),
    "growth_vs_monthly": Check(
        lambda t, v, day: checks.growth_vs_monthly(
            v["monthly_revenue"], v["monthly_revenue_growth"]
        ),
        flags=("completed_orders_match", "completed_items_match", "recognized_revenue_matches"),
    ),
    "growth_arithmetic": Check(
        lambda t, v, day: checks.growth_arithmetic_check(v["monthly_revenue_growth"]),
        zero=(
            "average_order_value_mismatches",
            "month_over_month_change_mismatches",
            "month_over_month_growth_mismatches",
            "year_over_year_change_mismatches",
            "year_over_year_growth_mismatches",
        ),
    ),
    "rolling_windows": Check(
        lambda t, v, day: checks.rolling_window_check(v["monthly_revenue_growth"]),
        zero=(
            "rolling_3_revenue_mismatches",
            "rolling_3_average_mismatches",
            "rolling_12_revenue_mismatches",
            "rolling_12_average_mismatches",
        ),
    ),
    "retention": Check(
        lambda t, v, day: checks.retention_check(
            v["customer_retention_cohorts"], t.order_items, day
        ),
        zero=(
            "duplicate_cohort_age_rows",
            "month_zero_customer_mismatches",
            "month_zero_retention_mismatches",
            "invalid_active_customer_rows",
            "invalid_cohort_age_rows",
            "activity_month_mismatches",
            "incomplete_or_future_month_rows",
            "retention_calculation_mismatches",
            "cohorts_with_changing_size",
        ),
        flags=(
            "expected_spine_rows_match",
            "one_month_zero_row_per_cohort",
            "cohort_sizes_match_buyers",
        ),
    ),
    "product_foundation": Check(
        lambda t, v, day: checks.product_foundation_reconcile(
            audits.product_foundation(t.order_items, t.products, day),
            v["monthly_revenue"],
            v["category_performance"],
        ),
        flags=(
            "one_row_per_item",
            "monthly_view_matches_source",
            "category_view_matches_source",
        ),
    ),
    "product_totals": Check(
        lambda t, v, day: checks.product_reconcile(
            t.order_items, t.products, v["category_performance"], day
        ),
        zero=("category_mismatches",),
        flags=(
            "one_row_per_product",
            "product_totals_match_source",
            "categories_match_existing_view",
        ),
    ),
    "products": Check(
        lambda t, v, day: checks.product_view_reconcile(
            v["product_performance"], t.order_items, t.products, v["category_performance"], day
        ),
        zero=("invalid_ranks", "category_mismatches", "missing_product_attributes"),
        flags=(
            "one_row_per_product",
            "product_view_matches_source",
            "categories_match_existing_view",
        ),
    ),
    "order_foundation": Check(
        lambda t, v, day: audits.order_operations_foundation(t.orders, day),
        flags=("one_row_per_order", "known_statuses_cover_all_orders"),
    ),
    "order_status": Check(
        lambda t, v, day: checks.status_check(v["monthly_order_status"], t.orders, day),
        zero=(
            "incomplete_or_future_months",
            "status_count_mismatches",
            "open_count_mismatches",
            "cancelled_share_mismatches",
            "returned_share_mismatches",
            "complete_share_mismatches",
        ),
        flags=("one_row_per_month", "calendar_is_continuous", "orders_match_source"),
    ),
    "duration_foundation": Check(
        lambda t, v, day: audits.order_duration_foundation(t.orders, day),
        flags=("one_row_per_candidate_order", "all_candidates_accounted_for"),
    ),
    "order_durations": Check(
        lambda t, v, day: checks.duration_check(v["monthly_order_durations"], t.orders, day),
        zero=(
            "missing_or_extra_months",
            "duplicate_or_missing_month_rows",
            "incomplete_or_future_months",
            "source_count_mismatches",
            "accounting_mismatches",
            "invalid_zero_counts",
            "coverage_mismatches",
            "average_mismatches",
            "elapsed_total_mismatches",
            "invalid_duration_summary_rows",
        ),
    ),
}


def run_checks(tables: RetailTables, views: Views, as_of: date) -> dict[str, DataFrame]:
    """Every check over the given views and their source."""
    return {name: check.run(tables, views, as_of) for name, check in CHECKS.items()}


def verdicts(check: str, result: DataFrame) -> DataFrame:
    """One row per rule of a check result: its value and whether it passed."""
    scope = F.col("duration_type") if "duration_type" in result.columns else F.lit("all")

    def rule(name: str, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"),
            F.col(name).cast("string").alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    declared = CHECKS[check]
    rules = [
        *[rule(name, F.col(name) == 0) for name in declared.zero],
        *[rule(name, F.col(name)) for name in declared.flags],
    ]
    return result.select(
        F.lit(check).alias("check_name"),
        scope.alias("scope"),
        F.explode(F.array(*rules)).alias("rule"),
    ).select("check_name", "scope", "rule.*")


def _listed(results: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [verdicts(n, df) for n, df in results.items()])


def validate_all(tables: RetailTables, as_of: date) -> DataFrame:
    """Read the source once, build the views once, list every rule with its outcome."""
    source = pin_tables(tables, as_of)
    return _listed(run_checks(source, pin_views(build_views(source, as_of)), as_of))


def validate_deployed(tables: RetailTables, deployed: Views, as_of: date) -> DataFrame:
    """Every rule with its outcome on views that are in use, not on views built for the check.

    ``deployed`` comes from ``publish.registered_views`` or ``publish.written_views``.
    The source is read once; a registered view is computed once.
    """
    return _listed(run_checks(pin_tables(tables, as_of), pin_views(deployed), as_of))


def view_totals(views: dict[str, DataFrame]) -> DataFrame:
    """The totals of one run: view, metric, value."""
    frames = []
    for name, metrics in VIEW_TOTALS.items():
        sums = views[name].agg(*[F.sum(m).cast("decimal(38,6)").alias(m) for m in metrics])
        frames.append(
            sums.unpivot([], list(metrics), "metric", "value").select(
                F.lit(name).alias("view_name"), "metric", "value"
            )
        )
    return reduce(DataFrame.unionByName, frames)


def snapshot_drift(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Totals of two runs side by side; a total missing in one run is drift."""
    keys = ["view_name", "metric"]
    before = earlier.select(*keys, F.col("value").alias("earlier_value"))
    after = later.select(*keys, F.col("value").alias("later_value"))
    joined = before.join(after, keys, "full")
    return joined.withColumn(
        "drifted", ~F.col("earlier_value").eqNullSafe(F.col("later_value"))
    )
