"""Each check passes on sound views and fires when one cell is wrong."""

from datetime import date
from functools import partial

import pytest
from pyspark.sql import functions as F

from orderlens.plans import audits, checks, validation, views
from orderlens.sources.mapping import TEST_AS_OF as DAY
from orderlens.sources.mapping import map_test_tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return validation.pin_tables(map_test_tables(spark, SMALL), DAY)


@pytest.fixture(scope="module")
def built(tables):
    return validation.pin_views(views.build_views(tables, DAY))


def test_everything_passes(tables, built):
    results = validation.run_checks(tables, built, DAY)
    for name, result in results.items():
        failed = validation.verdicts(name, result).filter("not passed").collect()
        assert failed == [], name


def test_combined_list(tables):
    rows = validation.validate_all(tables, DAY).collect()
    assert {r["check_name"] for r in rows} == set(validation.CHECKS)
    assert all(r["passed"] for r in rows)


def first(df, column):
    return df.agg(F.min(column)).first()[0]


def change(df, key, column, value):
    """Give ``column`` another value in the rows with the smallest ``key``."""
    hit = F.col(key) == F.lit(first(df, key))
    if isinstance(value, str):
        value = F.expr(value)
    return df.withColumn(column, F.when(hit, value).otherwise(F.col(column)))


def change_last(df, key, column, value):
    hit = F.col(key) == F.lit(df.agg(F.max(key)).first()[0])
    return df.withColumn(column, F.when(hit, F.expr(value)).otherwise(F.col(column)))


def drop_second(df, key):
    months = sorted(r[0] for r in df.select(key).distinct().collect())
    return df.filter(F.col(key) != F.lit(months[1]))


GROWTH, MONTHLY, STATUS = "monthly_revenue_growth", "monthly_revenue", "monthly_order_status"
RETENTION, DURATIONS, PRODUCTS = (
    "customer_retention_cohorts",
    "monthly_order_durations",
    "product_performance",
)
FUTURE = "date'2001-07-01'"

# view, corruption, check, rules that must fail
CASES = [
    (MONTHLY, partial(change, key="revenue_month", column="completed_orders", value="completed_orders + 1"),
     "reporting_views", {"orders_match"}),
    (MONTHLY, partial(change, key="revenue_month", column="completed_items", value="completed_items + 1"),
     "reporting_views", {"items_match"}),
    (MONTHLY, partial(change, key="revenue_month", column="recognized_revenue", value="recognized_revenue + 1"),
     "reporting_views", {"category_revenue_matches", "customer_revenue_matches"}),
    (MONTHLY, partial(change, key="revenue_month", column="revenue_month", value=FUTURE),
     "reporting_views", {"latest_month_is_complete"}),
    (GROWTH, partial(drop_second, key="revenue_month"),
     "growth_grain", {"calendar_is_continuous"}),
    (GROWTH, partial(change, key="revenue_month", column="revenue_month", value="add_months(revenue_month, 1)"),
     "growth_grain", {"one_row_per_month"}),
    (GROWTH, partial(change, key="revenue_month", column="revenue_month", value=FUTURE),
     "growth_grain", {"latest_month_is_complete"}),
    (GROWTH, partial(change, key="revenue_month", column="completed_orders", value="completed_orders + 1"),
     "growth_vs_monthly", {"completed_orders_match"}),
    (GROWTH, partial(change, key="revenue_month", column="recognized_revenue", value="recognized_revenue + 1"),
     "growth_vs_monthly", {"recognized_revenue_matches"}),
    (GROWTH, partial(change_last, key="revenue_month", column="average_order_value", value="average_order_value + 1"),
     "growth_arithmetic", {"average_order_value_mismatches"}),
    (GROWTH, partial(change_last, key="revenue_month", column="month_over_month_growth_pct", value="0"),
     "growth_arithmetic", {"month_over_month_growth_mismatches"}),
    (GROWTH, partial(change_last, key="revenue_month", column="year_over_year_revenue_change", value="0"),
     "growth_arithmetic", {"year_over_year_change_mismatches"}),
    (GROWTH, partial(change_last, key="revenue_month", column="rolling_3_month_revenue", value="0"),
     "rolling_windows", {"rolling_3_revenue_mismatches"}),
    (GROWTH, partial(change_last, key="revenue_month", column="rolling_12_month_average_revenue", value="0"),
     "rolling_windows", {"rolling_12_average_mismatches"}),
    (GROWTH, partial(change, key="revenue_month", column="rolling_12_month_revenue", value="0"),
     "rolling_windows", {"rolling_12_revenue_mismatches"}),
    (RETENTION, partial(change, key="cohort_month", column="cohort_customers", value="cohort_customers + 1"),
     "retention", {"cohort_sizes_match_buyers", "month_zero_customer_mismatches",
                   "retention_calculation_mismatches"}),
    (RETENTION, partial(change, key="months_since_first_purchase", column="retention_pct", value="99D"),
     "retention", {"month_zero_retention_mismatches"}),
    (RETENTION, lambda df: df.filter("months_since_first_purchase <> 5"),
     "retention", {"expected_spine_rows_match"}),
    (RETENTION, lambda df: df.unionByName(df.limit(1)),
     "retention", {"duplicate_cohort_age_rows"}),
    (RETENTION, partial(change, key="cohort_month", column="activity_month", value=FUTURE),
     "retention", {"activity_month_mismatches", "incomplete_or_future_month_rows"}),
    (RETENTION, partial(change_last, key="months_since_first_purchase", column="months_since_first_purchase", value="13"),
     "retention", {"invalid_cohort_age_rows"}),
    (RETENTION, partial(change_last, key="months_since_first_purchase", column="active_customers", value="-1"),
     "retention", {"invalid_active_customer_rows"}),
    (RETENTION, partial(change_last, key="months_since_first_purchase", column="cohort_customers", value="cohort_customers + 1"),
     "retention", {"cohorts_with_changing_size"}),
    (MONTHLY, partial(change, key="revenue_month", column="completed_items", value="0"),
     "product_foundation", {"monthly_view_matches_source"}),
    ("category_performance", partial(change, key="category", column="estimated_gross_profit", value="0"),
     "product_foundation", {"category_view_matches_source"}),
    ("category_performance", partial(change, key="category", column="category", value="'other'"),
     "products", {"category_mismatches", "categories_match_existing_view"}),
    (PRODUCTS, partial(change, key="product_id", column="recognized_revenue", value="recognized_revenue + 1"),
     "products", {"product_view_matches_source", "category_mismatches"}),
    (PRODUCTS, partial(change, key="product_id", column="category_revenue_rank", value="0"),
     "products", {"invalid_ranks"}),
    (PRODUCTS, partial(change, key="product_id", column="product_name", value="CAST(NULL AS STRING)"),
     "products", {"missing_product_attributes"}),
    (PRODUCTS, partial(change, key="product_id", column="category", value="CAST(NULL AS STRING)"),
     "products", {"missing_product_attributes", "category_mismatches"}),
    (PRODUCTS, lambda df: df.unionByName(df.limit(1)),
     "products", {"one_row_per_product"}),
    ("category_performance", partial(change, key="category", column="completed_items", value="0"),
     "product_totals", {"category_mismatches", "categories_match_existing_view"}),
    (STATUS, partial(change, key="created_month", column="shipped_orders", value="shipped_orders + 1"),
     "order_status", {"status_count_mismatches", "open_count_mismatches"}),
    (STATUS, partial(change, key="created_month", column="current_returned_share_pct", value="NULL"),
     "order_status", {"returned_share_mismatches"}),
    (STATUS, partial(drop_second, key="created_month"),
     "order_status", {"calendar_is_continuous", "orders_match_source"}),
    (STATUS, partial(change, key="created_month", column="created_month", value=FUTURE),
     "order_status", {"incomplete_or_future_months"}),
    (DURATIONS, partial(change, key="event_month", column="valid_duration_orders", value="valid_duration_orders + 1"),
     "order_durations", {"source_count_mismatches", "accounting_mismatches",
                         "coverage_mismatches", "average_mismatches"}),
    (DURATIONS, partial(drop_second, key="event_month"),
     "order_durations", {"missing_or_extra_months"}),
    (DURATIONS, partial(change, key="event_month", column="total_elapsed_days", value="total_elapsed_days + 0.01D"),
     "order_durations", {"elapsed_total_mismatches"}),
    (DURATIONS, partial(change, key="event_month", column="maximum_days", value="-1D"),
     "order_durations", {"invalid_duration_summary_rows"}),
    (DURATIONS, partial(change, key="event_month", column="zero_duration_orders", value="-1"),
     "order_durations", {"invalid_zero_counts"}),
    (DURATIONS, lambda df: df.unionByName(df),
     "order_durations", {"duplicate_or_missing_month_rows"}),
    (DURATIONS, partial(change, key="event_month", column="event_month", value=FUTURE),
     "order_durations", {"incomplete_or_future_months"}),
]


@pytest.mark.parametrize("view, corrupt, check, rules", CASES)
def test_check_fires(tables, built, view, corrupt, check, rules):
    changed = {**built, view: corrupt(built[view])}
    result = validation.run_checks(tables, changed, DAY)[check]
    failed = validation.verdicts(check, result).filter("not passed").collect()
    assert rules <= {r["metric"] for r in failed}


def test_duplicate_items_fire(tables, built):
    doubled = tables.order_items.unionByName(tables.order_items)
    result = checks.product_foundation_reconcile(
        audits.product_foundation(doubled, tables.products, DAY),
        built[MONTHLY],
        built["category_performance"],
    ).first()
    assert result["one_row_per_item"] is False
    assert result["monthly_view_matches_source"] is False


def test_foundations_fire_on_repeated_and_unknown_orders(tables, built):
    """Rules on the source: repeated orders, a status that is none of the five."""
    odd = F.when(F.col("order_id") % 50 == 0, "Lost").otherwise(F.col("status"))
    orders = tables.orders.unionByName(tables.orders.limit(3)).withColumn("status", odd)
    changed = validation.RetailTables(orders, tables.order_items, tables.products, tables.users)
    results = validation.run_checks(changed, built, DAY)

    def failed(check):
        rows = validation.verdicts(check, results[check]).filter("not passed").collect()
        return {r["metric"] for r in rows}

    assert failed("order_foundation") == {"one_row_per_order", "known_statuses_cover_all_orders"}
    completed = tables.orders.filter("status = 'Returned'")
    repeated = validation.RetailTables(
        tables.orders.unionByName(completed), tables.order_items, tables.products, tables.users
    )
    results = validation.run_checks(repeated, built, DAY)
    assert failed("duration_foundation") == {"one_row_per_candidate_order"}


def test_cohort_start_shows_the_differing_view(tables, built):
    month = date(1995, 1, 1)
    monthly = change(built[MONTHLY], "revenue_month", "recognized_revenue", "0")
    row = checks.cohort_start_check(
        tables.order_items, monthly, built[GROWTH], month, month
    ).first()
    assert row["source_recognized_revenue"] == row["growth_view_revenue"]
    assert row["existing_view_revenue"] == 0


def test_drift_between_runs(tables, built):
    earlier = validation.view_totals(built)
    same = validation.snapshot_drift(earlier, validation.view_totals(built))
    assert same.filter("drifted").count() == 0
    moved = {**built, STATUS: change(built[STATUS], "created_month", "created_orders", "0")}
    drifted = validation.snapshot_drift(earlier, validation.view_totals(moved))
    assert [(r["view_name"], r["metric"]) for r in drifted.filter("drifted").collect()] == [
        (STATUS, "created_orders")
    ]
