"""Stored monthly states after appends and corrections, against full rebuilds."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlens.plans import refresh, views
from orderlens.sources import RetailTables

AS_OF = date(2001, 7, 15)
ORDERS = (
    "order_id long, user_id long, status string, created_at timestamp, shipped_at timestamp, "
    "delivered_at timestamp, returned_at timestamp, num_of_item long"
)
ITEMS = (
    "id long, order_id long, user_id long, product_id long, status string, created_at timestamp, "
    "shipped_at timestamp, delivered_at timestamp, returned_at timestamp, sale_price decimal(18,2)"
)
STATUSES = ("Processing", "Shipped", "Complete", "Cancelled", "Returned", None)


def order(rng, key):
    created = datetime(2000, 1, 1) + timedelta(hours=rng.randrange(24 * 580))
    times = [created]
    for _ in range(3):
        times.append(times[-1] + timedelta(hours=rng.randrange(-5, 400)))
    times = [None if rng.random() < 0.1 else t for t in times]
    return (key, key % 5, rng.choice(STATUSES), *times, 1)


def item(row, key):
    rng = random.Random(f"{row}{key}")
    price = None if rng.random() < 0.05 else round(rng.random() * 90, 2)
    return (key, *row[:2], key % 7, *row[2:7], price)


def frames(spark, orders):
    from decimal import Decimal

    items = [item(row, 10 * row[0] + k) for row in orders for k in range(1 + row[0] % 3)]
    items = [(*i[:9], None if i[9] is None else Decimal(str(i[9]))) for i in items]
    products = spark.createDataFrame([], "id long, name string, category string, cost double")
    return RetailTables(
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(items, ITEMS),
        products,
        products.select("id"),
    )


def full(tables, as_of=AS_OF):
    built = {
        "monthly_revenue": views.monthly_revenue(tables.order_items, as_of),
        "monthly_revenue_growth": views.monthly_revenue_growth(tables.order_items, as_of),
        "monthly_order_status": views.monthly_order_status(tables.orders, as_of),
        "monthly_order_durations": views.monthly_order_durations(tables.orders, as_of),
    }
    assert set(built) == set(refresh.VIEWS)
    return {name: sorted(df.collect(), key=repr) for name, df in built.items()}


def refreshed(state, as_of=AS_OF):
    return {name: sorted(df.collect(), key=repr) for name, df in state.views(as_of).items()}


def corrected(rng, orders):
    """New, changed and removed orders, mostly late ones, and the rows that changed."""
    kept, changed, now = [], [], []
    for row in orders:
        hit = rng.random() if row[0] % 20 == 0 else 1.0
        if hit < 0.1:
            changed.append(row)
        elif hit < 0.4:
            new = order(rng, row[0])
            changed += [row, new]
            now.append(new)
        else:
            kept.append(row)
    added = [order(rng, 1000 + k) for k in range(2)]
    return kept + now + added, changed + added


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_a_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    orders = [order(rng, k) for k in range(150)]
    state = refresh.MonthlyState(spark, str(tmp_path))
    state.rebuild(frames(spark, orders))
    assert refreshed(state) == full(frames(spark, orders))
    for _ in range(2):
        orders, changed = corrected(rng, orders)
        now = frames(spark, orders)
        touched = refresh.months_touched(frames(spark, changed))
        # Some months are left as they were.
        assert 0 < len(touched["revenue"]) < len(full(now)["monthly_revenue"])
        state.refresh(now, touched)
        assert refreshed(state) == full(now)
    # The as-of date only selects months.
    earlier = date(2001, 3, 1)
    assert refreshed(state, earlier) == full(now, earlier)


def test_only_touched_months_are_replaced(spark, tmp_path):
    rng = random.Random(3)
    orders = [order(rng, k) for k in range(120)]
    state = refresh.MonthlyState(spark, str(tmp_path))
    state.rebuild(frames(spark, orders))
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    late = (900, 1, "Complete", *[datetime(2001, 2, d) for d in (3, 4, 5)], None, 1)
    now = frames(spark, [*orders, late])
    touched = refresh.months_touched(frames(spark, [late]))
    assert touched == {
        "revenue": [date(2001, 2, 1)],
        "status": [date(2001, 2, 1)],
        "durations": [date(2001, 2, 1)],
    }
    state.refresh(now, touched)
    replaced = {p for p in files if not p.exists()}
    assert replaced and all("month_key=2001-02" in str(p) for p in replaced)
    assert refreshed(state) == full(now)


def test_only_touched_months_are_read(spark, tmp_path, settings):
    """The ranges reach the scan of the source."""
    settings(spark__sql__maxMetadataStringLength="5000")
    orders = [order(random.Random(5), k) for k in range(50)]
    now = frames(spark, orders)
    now.order_items.write.parquet(f"{tmp_path}/items")
    stored = RetailTables(
        now.orders, spark.read.parquet(f"{tmp_path}/items"), now.products, now.users
    )
    state = refresh.MonthlyState(spark, f"{tmp_path}/state")
    months = [date(2000, 12, 1), date(2001, 1, 1), date(2001, 5, 1)]
    rows = state.recomputed("revenue", stored, months)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    pushed = pushed.split("PushedFilters")[1]
    for bound in ("2000-12-01", "2001-02-01", "2001-05-01", "2001-06-01"):
        assert bound in pushed, pushed
    assert "2001-01-01" not in pushed
    condition = refresh.in_months(["delivered_at"], months)
    inside = {r[0] for r in now.order_items.filter(condition).select(F.trunc("delivered_at", "month")).collect()}
    assert inside <= set(months)


def test_a_month_that_lost_its_rows(spark, tmp_path):
    alone = (1, 1, "Complete", *[datetime(2001, 2, d) for d in (3, 4, 5)], None, 1)
    other = (2, 1, "Complete", *[datetime(2001, 4, d) for d in (3, 4, 5)], None, 1)
    state = refresh.MonthlyState(spark, str(tmp_path))
    state.rebuild(frames(spark, [alone, other]))
    state.refresh(frames(spark, [other]), refresh.months_touched(frames(spark, [alone])))
    assert refreshed(state) == full(frames(spark, [other]))
    state.refresh(frames(spark, []), refresh.months_touched(frames(spark, [other])))
    assert refreshed(state) == full(frames(spark, []))
    state.refresh(frames(spark, [alone]), refresh.months_touched(frames(spark, [alone])))
    assert refreshed(state) == full(frames(spark, [alone]))


def test_an_empty_source(spark, tmp_path):
    state = refresh.MonthlyState(spark, str(tmp_path))
    state.rebuild(frames(spark, []))
    assert refreshed(state) == full(frames(spark, []))
