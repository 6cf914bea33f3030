"""One hand-made case per edge."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from orderlens.functions import numbers
from orderlens.plans import audits, views
from pyspark.sql import functions as F

AS_OF = date(2024, 7, 15)
ITEM = (
    "id long, order_id long, user_id long, product_id long, status string, "
    "created_at timestamp, shipped_at timestamp, delivered_at timestamp, "
    "returned_at timestamp, sale_price decimal(18,2)"
)
ORDER = (
    "order_id long, user_id long, status string, created_at timestamp, "
    "shipped_at timestamp, delivered_at timestamp, returned_at timestamp, num_of_item long"
)


def items(spark, *rows):
    """Rows of (order, user, product, delivered, price)."""
    return spark.createDataFrame(
        [
            (n, o, u, p, "Complete", None, None, d, None, None if s is None else Decimal(s))
            for n, (o, u, p, d, s) in enumerate(rows)
        ],
        ITEM,
    )


def orders(spark, *rows):
    """Rows of (status, created, shipped, delivered, returned)."""
    return spark.createDataFrame(
        [(n, 1, *row, 1) for n, row in enumerate(rows)], ORDER
    )


def on(month, day=10, year=2024):
    return datetime(year, month, day)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_month_without_delivery(spark):
    df = items(spark, (1, 1, 1, on(3), "10"), (2, 1, 1, on(5), "15"))
    observed = by(views.monthly_revenue(df, AS_OF), "revenue_month")
    assert sorted(observed) == [date(2024, 3, 1), date(2024, 5, 1)]
    assert observed[date(2024, 5, 1)]["previous_month_revenue"] == 10
    assert observed[date(2024, 5, 1)]["revenue_growth_pct"] == 50

    full = by(views.monthly_revenue_growth(df, AS_OF), "revenue_month")
    gap, after = full[date(2024, 4, 1)], full[date(2024, 5, 1)]
    assert (gap["completed_orders"], gap["recognized_revenue"]) == (0, 0)
    assert gap["average_order_value"] is None
    assert after["previous_month_revenue"] == 0
    assert after["month_over_month_growth_pct"] is None
    assert after["rolling_3_month_revenue"] == 25
    assert gap["rolling_3_month_revenue"] is None
    assert after["rolling_12_month_revenue"] is None

    months = audits.delivery_month_continuity(df, AS_OF).collect()
    assert months[0]["month"] == date(2024, 4, 1) and months[0]["is_missing_delivery_month"]


def test_boundary_of_the_as_of_month(spark):
    df = items(
        spark,
        (1, 1, 1, datetime(2024, 6, 30, 23, 59, 59), "10"),
        (2, 1, 1, datetime(2024, 7, 1), "99"),
    )
    found = views.monthly_revenue(df, AS_OF).collect()
    assert [r["recognized_revenue"] for r in found] == [10]


def test_equal_revenue_shares_a_rank(spark):
    df = items(
        spark,
        (1, 1, 1, on(3), "10"),
        (2, 1, 2, on(3), "10"),
        (3, 1, 3, on(3), "4"),
    )
    products = spark.createDataFrame(
        [(1, "x", "A", 1.0, 9.0), (2, "x", "B", 1.0, 9.0), (3, "y", None, 1.0, 9.0)],
        "id long, name string, category string, cost double, retail_price double",
    )
    ranks = by(views.category_performance(df, products, AS_OF), "category")
    assert {c: r["revenue_rank"] for c, r in ranks.items()} == {"A": 1, "B": 1, None: 3}
    assert ranks[None]["estimated_gross_profit"] == 3
    performance = by(views.product_performance(df, products, AS_OF), "product_id")
    assert [performance[p]["overall_revenue_rank"] for p in (1, 2, 3)] == [1, 1, 3]
    top = views.top_products(df, products, AS_OF, 2).collect()
    assert [r["product_id"] for r in top] == [1, 2]


def test_segments_and_same_month_orders(spark):
    df = items(
        spark,
        (1, 1, 1, on(3), "10"),
        (2, 2, 1, on(3), "10"),
        (3, 2, 1, on(3), "10"),
        (4, None, 1, on(3), "7"),
    )
    users = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    found = by(views.customer_segments(df, users, AS_OF), "customer_segment")
    assert {s: r["customers"] for s, r in found.items()} == {
        "No completed purchases": 1,
        "One-time customer": 1,
        "Repeat customer": 1,
    }
    assert found["No completed purchases"]["recognized_revenue"] == 0
    cohorts = views.customer_retention_cohorts(df, AS_OF).collect()
    start = [r for r in cohorts if r["months_since_first_purchase"] == 0]
    assert [(r["cohort_customers"], r["active_customers"]) for r in start] == [(2, 2)]
    foundation = audits.retention_foundation(df, AS_OF).first()
    assert (foundation["customer_rows"], foundation["missing_user_ids"]) == (3, 1)


def test_retention_gap_and_recent_cohort(spark):
    df = items(
        spark,
        (1, 1, 1, on(2), "1"),
        (2, 1, 1, on(5), "1"),
        (3, 2, 1, on(6), "1"),
        (4, 3, 1, on(1, year=2020), "1"),
        (5, 3, 1, on(6, year=2024), "1"),
    )
    found = {
        (r["cohort_month"], r["months_since_first_purchase"]): r
        for r in views.customer_retention_cohorts(df, AS_OF).collect()
    }
    february = [found[date(2024, 2, 1), n]["active_customers"] for n in range(5)]
    assert february == [1, 0, 0, 1, 0]
    assert [n for c, n in found if c == date(2024, 6, 1)] == [0]
    assert max(n for c, n in found if c == date(2020, 1, 1)) == 12
    assert found[date(2024, 2, 1), 3]["activity_month"] == date(2024, 5, 1)


def test_order_status_gap(spark):
    df = orders(
        spark,
        ("Processing", on(3), None, None, None),
        ("Lost", on(5), None, None, None),
        (None, on(5), None, None, None),
        ("Complete", None, None, None, None),
    )
    found = by(views.monthly_order_status(df, AS_OF), "created_month")
    gap = found[date(2024, 4, 1)]
    assert (gap["created_orders"], gap["current_complete_share_pct"]) == (0, None)
    assert found[date(2024, 5, 1)]["created_orders"] == 2
    assert found[date(2024, 5, 1)]["current_complete_share_pct"] == 0
    checked = audits.order_operations_foundation(df, AS_OF).first()
    assert (checked["missing_status"], checked["unexpected_status"]) == (1, 1)
    assert checked["missing_created_at"] == 1
    assert checked["known_statuses_cover_all_orders"] is False


def test_duration_outcomes(spark):
    end = datetime(2024, 3, 10, 12)
    df = orders(
        spark,
        ("Complete", None, datetime(2024, 3, 10, 11, 59, 58, 800000), end, None),
        ("Complete", None, end, end, None),
        ("Complete", None, None, end, None),
        ("Complete", None, datetime(2024, 3, 11), end, None),
        ("Complete", None, end, None, None),
        ("Complete", None, None, on(7), None),
        ("Returned", None, None, datetime(2024, 4, 2), datetime(2024, 4, 1)),
    )
    found = {
        (r["duration_type"], r["event_month"]): r
        for r in views.monthly_order_durations(df, AS_OF).collect()
    }
    assert len(found) == 3
    march = found["shipping_to_delivery", date(2024, 3, 1)]
    assert march["ended_orders"] == 4
    assert march["valid_duration_orders"] == 2
    assert march["missing_start_orders"] == march["reversed_timestamp_orders"] == 1
    assert march["zero_duration_orders"] == 1
    assert march["total_elapsed_days"] == 1 / 86400
    april = found["delivery_to_return", date(2024, 4, 1)]
    assert (april["valid_duration_orders"], april["valid_duration_share_pct"]) == (0, 0)
    assert april["average_days"] is april["approximate_median_days"] is None
    assert april["total_elapsed_days"] is april["maximum_days"] is None

    history = by(audits.order_duration_foundation(df, AS_OF), "duration_type")
    shipping = history["shipping_to_delivery"]
    assert shipping["missing_end_orders"] == 1
    # Start missing and end in the open month: the open month decides.
    assert shipping["incomplete_or_future_end_month_orders"] == 1
    assert shipping["all_candidates_accounted_for"] is True


@pytest.mark.parametrize(
    "name",
    [
        "monthly_revenue",
        "monthly_revenue_growth",
        "customer_retention_cohorts",
    ],
)
def test_no_items(spark, name):
    assert getattr(views, name)(items(spark), AS_OF).count() == 0


def test_no_rows_elsewhere(spark):
    products = spark.createDataFrame(
        [], "id long, name string, category string, cost double, retail_price double"
    )
    assert views.product_performance(items(spark), products, AS_OF).count() == 0
    assert views.category_performance(items(spark), products, AS_OF).count() == 0
    assert views.monthly_order_status(orders(spark), AS_OF).count() == 0
    assert views.monthly_order_durations(orders(spark), AS_OF).count() == 0
    assert audits.price_distribution(items(spark), products).first()["order_item_rows"] == 0


def test_floating_prices_are_summed_exactly(spark):
    rows = [(n, 1, 1, on(3), None) for n in range(10)]
    df = items(spark, *rows).withColumn("sale_price", F.lit(0.1).cast("double"))
    assert views.monthly_revenue(df, AS_OF).first()["recognized_revenue"] == Decimal("1.00")


@pytest.mark.parametrize(
    "value, expected", [("1.005", "1.01"), ("2.345", "2.35"), ("-1.005", "-1.01")]
)
def test_rounding(spark, value, expected):
    row = spark.range(1).select(numbers.round2(F.lit(float(value))).alias("r")).first()
    assert row["r"] == Decimal(expected)


def test_ratio_of_zero(spark):
    row = spark.range(1).select(numbers.pct(F.lit(5), F.lit(0)).alias("r")).first()
    assert row["r"] is None


def test_timestamps_with_and_without_zone_agree(spark):
    zoned = items(spark, (1, 1, 1, datetime(2024, 6, 30, 23, 59, 59), "10"))
    local = zoned.withColumns(
        {
            f"{e}_at": F.col(f"{e}_at").cast("timestamp_ntz")
            for e in ("created", "shipped", "delivered", "returned")
        }
    )
    assert (
        views.monthly_revenue(zoned, AS_OF).collect()
        == views.monthly_revenue(local, AS_OF).collect()
    )


def test_estimated_percentiles_stay_close(spark):
    from orderlens.sources.mapping import TEST_AS_OF, map_test_tables

    source = map_test_tables(spark, "/root/testdata/sf0.001").orders
    points = {"approximate_median_days", "approximate_p90_days"}
    for report, keys in (
        (views.monthly_order_durations, ["duration_type", "event_month"]),
        (audits.order_duration_foundation, ["duration_type"]),
    ):
        exact = {tuple(r[k] for k in keys): r.asDict() for r in report(source, TEST_AS_OF).collect()}
        found = report(source, TEST_AS_OF, exact=False).collect()
        assert len(found) == len(exact)
        for row in found:
            expected = exact[tuple(row[k] for k in keys)]
            for name, value in expected.items():
                if name in points:
                    assert (value is None) == (row[name] is None)
                    assert value is None or abs(row[name] - value) <= 0.05
                else:
                    assert row[name] == value, name
