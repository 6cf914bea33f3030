"""DuckDB statements that compute the registered queries a second way.

Each statement is a list of named subqueries followed by a select. Money is
exact decimal inside and DOUBLE in the result.
"""

from __future__ import annotations

import re

MONTH_START = "DATE '2001-07-01'"
AS_OF = "DATE '2001-07-15'"
LAST_MONTH = "DATE '2001-06-01'"
EVENTS = ("created", "shipped", "delivered", "returned")
STATUSES = ("Processing", "Shipped", "Complete", "Cancelled", "Returned")


def r2(x: str) -> str:
    return f"round(CAST({x} AS DECIMAL(38,9)), 2)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def rdiv(a: str, b: str) -> str:
    return r2(div(a, b))


def pct(a: str, b: str) -> str:
    return r2(f"{div(a, b)} * 100")


def dpct(a: str, b: str) -> str:
    return f"CAST({pct(a, b)} AS DOUBLE)"


def n_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def isum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def msum(x: str) -> str:
    return r2(f"sum({x})")


def month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def plus(start: str, seconds: str) -> str:
    return f"{start} + to_seconds({seconds})"


def calendar(source: str, column: str) -> str:
    """Every month from the first to the last value of a column."""
    return (
        f"SELECT CAST(unnest(generate_series(min({column}), max({column}), INTERVAL 1 MONTH)) "
        f"AS DATE) AS m FROM {source}"
    )


PARTS: dict[str, str] = {
    # --- retail tables from the wholesale test tables
    "staged": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS created_at,
          CASE WHEN o_orderstatus = 'P' THEN 'Processing'
               WHEN o_orderstatus = 'O' THEN 'Shipped'
               WHEN left(o_orderpriority, 1) = '4' THEN 'Cancelled'
               WHEN left(o_orderpriority, 1) IN ('1', '2', '3') THEN 'Complete'
               ELSE 'Returned' END AS status
        FROM orders""",
    "sent": f"""
        SELECT *, CASE WHEN status IN ('Shipped', 'Complete', 'Returned')
          THEN {plus('created_at', 'order_id * 7919 % 259201')} END AS shipped_at
        FROM staged""",
    "arrived": f"""
        SELECT *, CASE WHEN status IN ('Complete', 'Returned')
          THEN {plus('shipped_at', 'order_id * 104729 % 432001')} END AS delivered_at
        FROM sent""",
    "parents": f"""
        SELECT *, CASE WHEN status = 'Returned'
          THEN {plus('delivered_at', 'order_id * 1299709 % 259201')} END AS returned_at
        FROM arrived""",
    "ord": """
        SELECT p.*, coalesce(c.n, 0) AS num_of_item FROM parents p
        LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c
          ON c.l_orderkey = p.order_id""",
    "itm": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         CAST(l_shipdate AS DATE)) AS id,
          p.order_id, p.user_id, l_partkey AS product_id, p.status,
          {plus('p.created_at', '(l_partkey * 37 + l_linenumber * 40009) % 345601')}
            AS created_at,
          p.shipped_at, p.delivered_at, p.returned_at,
          CAST(l_extendedprice AS DECIMAL(18,2)) AS sale_price
        FROM lineitem JOIN parents p ON l_orderkey = p.order_id""",
    "prd": """
        SELECT p_partkey AS id, p_name AS name, p_type AS category,
          CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price,
          CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)) AS cost
        FROM part""",
    "usr": "SELECT c_custkey AS id FROM customer",
    "sold": f"""
        SELECT * FROM itm WHERE status = 'Complete' AND delivered_at < {MONTH_START}""",
    "sold_products": """
        SELECT s.order_id, s.id AS item_id, s.product_id, s.sale_price, p.name, p.category, p.cost,
          s.sale_price - p.cost AS profit
        FROM sold s JOIN prd p ON p.id = s.product_id""",
    "per_month": f"""
        SELECT {month('delivered_at')} AS m, count(DISTINCT order_id) AS orders,
          count(*) AS items, sum(sale_price) AS revenue
        FROM sold GROUP BY 1""",
    # --- the eight views
    "monthly_revenue": f"""
        SELECT m AS revenue_month, orders AS completed_orders, items AS completed_items,
          rev AS recognized_revenue, {rdiv('revenue', 'orders')} AS average_order_value,
          prev AS previous_month_revenue, {r2('rev - prev')} AS revenue_change,
          {pct('rev - prev', 'prev')} AS revenue_growth_pct
        FROM (SELECT *, lag(rev) OVER (ORDER BY m) AS prev
              FROM (SELECT *, {r2('revenue')} AS rev FROM per_month))""",
    "category_performance": f"""
        SELECT c.category,
          rank() OVER (ORDER BY c.revenue DESC NULLS LAST) AS revenue_rank,
          c.orders AS completed_orders, c.items AS completed_items,
          {r2('c.revenue')} AS recognized_revenue, {r2('c.profit')} AS estimated_gross_profit,
          {pct('c.profit', 'c.revenue')} AS gross_margin_pct,
          {pct('c.revenue', '(SELECT sum(revenue) FROM per_category)')} AS revenue_share_pct
        FROM per_category c""",
    "per_category": """
        SELECT category, count(DISTINCT order_id) AS orders, count(*) AS items,
          sum(sale_price) AS revenue, sum(profit) AS profit
        FROM sold_products GROUP BY category""",
    "purchases": """
        SELECT user_id, order_id, sum(sale_price) AS spent FROM sold GROUP BY ALL""",
    "buyers": """
        SELECT u.id, count(p.order_id) AS orders, coalesce(sum(p.spent), 0) AS revenue
        FROM usr u LEFT JOIN purchases p ON p.user_id = u.id GROUP BY u.id""",
    "customer_segments": f"""
        SELECT CASE WHEN orders = 0 THEN 'No completed purchases'
               WHEN orders = 1 THEN 'One-time customer' ELSE 'Repeat customer' END
            AS customer_segment,
          count(*) AS customers, {isum('orders')} AS completed_orders,
          {msum('revenue')} AS recognized_revenue,
          {rdiv('sum(orders)', 'count(*)')} AS average_orders_per_customer,
          {rdiv('sum(revenue)', 'count(*)')} AS average_revenue_per_customer
        FROM buyers GROUP BY 1""",
    "month_series": f"""
        SELECT c.m, coalesce(orders, 0) AS orders, coalesce(items, 0) AS items,
          coalesce(revenue, 0) AS revenue, p.m IS NULL AS gap
        FROM ({calendar('per_month', 'm')}) c LEFT JOIN per_month p USING (m)""",
    "month_windows": """
        SELECT *, lag(revenue) OVER w AS prev, lag(revenue, 12) OVER w AS prev_year,
          row_number() OVER w AS position,
          sum(revenue) OVER (w ROWS 2 PRECEDING) AS sum3,
          sum(revenue) OVER (w ROWS 11 PRECEDING) AS sum12
        FROM month_series WINDOW w AS (ORDER BY m)""",
    "monthly_revenue_growth": f"""
        SELECT m AS revenue_month, orders AS completed_orders, items AS completed_items,
          {r2('revenue')} AS recognized_revenue, {rdiv('revenue', 'orders')}
            AS average_order_value,
          {r2('prev')} AS previous_month_revenue,
          {r2('revenue - prev')} AS month_over_month_revenue_change,
          {pct('revenue - prev', 'prev')} AS month_over_month_growth_pct,
          {r2('prev_year')} AS previous_year_revenue,
          {r2('revenue - prev_year')} AS year_over_year_revenue_change,
          {pct('revenue - prev_year', 'prev_year')} AS year_over_year_growth_pct,
          CASE WHEN position >= 3 THEN {r2('sum3')} END AS rolling_3_month_revenue,
          CASE WHEN position >= 3 THEN {rdiv('sum3', '3')} END
            AS rolling_3_month_average_revenue,
          CASE WHEN position >= 12 THEN {r2('sum12')} END AS rolling_12_month_revenue,
          CASE WHEN position >= 12 THEN {rdiv('sum12', '12')} END
            AS rolling_12_month_average_revenue
        FROM month_windows""",
    "visits": f"""
        SELECT DISTINCT user_id, {month('delivered_at')} AS m
        FROM sold WHERE user_id IS NOT NULL""",
    "joined_in": "SELECT user_id, min(m) AS cohort FROM visits GROUP BY user_id",
    "cohort_sizes": f"""
        SELECT cohort, count(*) AS size,
          least(12, date_diff('month', cohort, {LAST_MONTH})) AS oldest
        FROM joined_in GROUP BY cohort""",
    "customer_retention_cohorts": f"""
        SELECT g.cohort AS cohort_month, g.age AS months_since_first_purchase,
          CAST(g.cohort + to_months(CAST(g.age AS INTEGER)) AS DATE) AS activity_month,
          g.size AS cohort_customers, count(v.user_id) AS active_customers,
          {dpct('count(v.user_id)', 'g.size')} AS retention_pct
        FROM (SELECT *, unnest(range(0, oldest + 1)) AS age FROM cohort_sizes) g
        JOIN joined_in j USING (cohort)
        LEFT JOIN visits v ON v.user_id = j.user_id
          AND date_diff('month', j.cohort, v.m) = g.age
        GROUP BY g.cohort, g.age, g.size""",
    "per_product": """
        SELECT product_id, name AS product_name, category,
          count(DISTINCT order_id) AS completed_orders, count(*) AS completed_items,
          sum(sale_price) AS recognized_revenue, sum(cost) AS estimated_product_cost,
          sum(profit) AS estimated_gross_profit
        FROM sold_products GROUP BY ALL""",
    "by_product": """
        SELECT product_id, category, count(*) AS completed_items,
          sum(sale_price) AS recognized_revenue, sum(profit) AS estimated_gross_profit
        FROM sold_products GROUP BY product_id, category""",
    "product_performance": f"""
        SELECT product_id, product_name, category,
          rank() OVER (ORDER BY recognized_revenue DESC NULLS LAST) AS overall_revenue_rank,
          rank() OVER (PARTITION BY category
            ORDER BY recognized_revenue DESC NULLS LAST)
            AS category_revenue_rank,
          completed_orders, completed_items, recognized_revenue, estimated_product_cost,
          estimated_gross_profit,
          {pct('estimated_gross_profit', 'recognized_revenue')} AS estimated_gross_margin_pct,
          {pct('recognized_revenue', 'sum(recognized_revenue) OVER ()')}
            AS total_revenue_share_pct,
          {pct('recognized_revenue', 'sum(recognized_revenue) OVER (PARTITION BY category)')}
            AS category_revenue_share_pct
        FROM per_product""",
    "created": f"""
        SELECT {month('created_at')} AS m, count(*) AS created_orders,
          {', '.join(f"{n_if(f"status = '{s}'")} AS {s.lower()}_orders" for s in STATUSES)}
        FROM ord WHERE created_at < {MONTH_START} GROUP BY 1""",
    "monthly_order_status": f"""
        SELECT cal.m AS created_month, coalesce(created_orders, 0) AS created_orders,
          {', '.join(f"coalesce({s.lower()}_orders, 0) AS {s.lower()}_orders" for s in STATUSES)},
          coalesce(processing_orders + shipped_orders, 0) AS currently_open_orders,
          {', '.join(f"{dpct(f'{s}_orders', 'created_orders')} AS current_{s}_share_pct"
                     for s in ('cancelled', 'returned', 'complete'))}
        FROM ({calendar('created', 'm')}) cal LEFT JOIN created USING (m)""",
    "spans": """
        SELECT 'shipping_to_delivery' AS duration_type, order_id, shipped_at AS s,
          delivered_at AS e FROM ord WHERE status IN ('Complete', 'Returned')
        UNION ALL
        SELECT 'delivery_to_return', order_id, delivered_at, returned_at
        FROM ord WHERE status = 'Returned'""",
    "graded": f"""
        SELECT *, CASE WHEN grade = 'ok' THEN date_sub('second', s, e) END AS secs FROM (
          SELECT *, CASE WHEN e IS NULL THEN 'no end' WHEN e >= {MONTH_START} THEN 'open'
            WHEN s IS NULL THEN 'no start' WHEN s > e THEN 'reversed' ELSE 'ok' END AS grade
          FROM spans)""",
    "monthly_order_durations": f"""
        SELECT duration_type, {month('e')} AS event_month, count(*) AS ended_orders,
          count(secs) AS valid_duration_orders,
          {n_if("grade = 'no start'")} AS missing_start_orders,
          {n_if("grade = 'reversed'")} AS reversed_timestamp_orders,
          {n_if('secs = 0')} AS zero_duration_orders,
          {dpct('count(secs)', 'count(*)')} AS valid_duration_share_pct,
          sum(secs) / 86400.0::DOUBLE AS total_elapsed_days,
          CAST({r2('(sum(secs) / 86400.0::DOUBLE) / NULLIF(count(secs), 0)')} AS DOUBLE)
            AS average_days,
          CAST({r2('quantile_disc(secs, 0.5) / 86400.0::DOUBLE')} AS DOUBLE)
            AS approximate_median_days,
          CAST({r2('quantile_disc(secs, 0.9) / 86400.0::DOUBLE')} AS DOUBLE)
            AS approximate_p90_days,
          CAST({r2('max(secs) / 86400.0::DOUBLE')} AS DOUBLE) AS maximum_days
        FROM graded WHERE grade NOT IN ('no end', 'open') GROUP BY 1, 2""",
}

# What each subquery reads, so that a statement only carries what it needs.
READS = {
    "sent": ["staged"],
    "arrived": ["sent"],
    "parents": ["arrived"],
    "ord": ["parents"],
    "itm": ["parents"],
    "sold": ["itm"],
    "sold_products": ["sold", "prd"],
    "per_month": ["sold"],
    "monthly_revenue": ["per_month"],
    "per_category": ["sold_products"],
    "category_performance": ["per_category"],
    "purchases": ["sold"],
    "buyers": ["usr", "purchases"],
    "customer_segments": ["buyers"],
    "month_series": ["per_month"],
    "month_windows": ["month_series"],
    "monthly_revenue_growth": ["month_windows"],
    "visits": ["sold"],
    "joined_in": ["visits"],
    "cohort_sizes": ["joined_in"],
    "customer_retention_cohorts": ["cohort_sizes", "visits"],
    "per_product": ["sold_products"],
    "by_product": ["sold_products"],
    "product_performance": ["per_product"],
    "created": ["ord"],
    "monthly_order_status": ["created"],
    "spans": ["ord"],
    "graded": ["spans"],
    "monthly_order_durations": ["graded"],
}


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        _ordered(READS.get(name, []), seen)
        if name not in seen:
            seen.append(name)
    return seen


def statement(reads: str, select: str, money: str = "") -> str:
    """Subqueries needed by ``reads``, then ``select`` with money as DOUBLE."""
    named = ",\n".join(f"{n} AS ({PARTS[n]})" for n in _ordered(reads.split(), []))
    replaced = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money.split())
    columns = f"* REPLACE ({replaced})" if replaced else "*"
    return f"WITH {named}\nSELECT {columns} FROM ({select})"


MONTHLY_MONEY = (
    "recognized_revenue average_order_value previous_month_revenue revenue_change "
    "revenue_growth_pct"
)
CATEGORY_MONEY = "recognized_revenue estimated_gross_profit gross_margin_pct revenue_share_pct"
SEGMENT_MONEY = (
    "recognized_revenue average_orders_per_customer average_revenue_per_customer"
)
GROWTH_MONEY = (
    "recognized_revenue average_order_value previous_month_revenue "
    "month_over_month_revenue_change month_over_month_growth_pct previous_year_revenue "
    "year_over_year_revenue_change year_over_year_growth_pct rolling_3_month_revenue "
    "rolling_3_month_average_revenue rolling_12_month_revenue rolling_12_month_average_revenue"
)
PRODUCT_MONEY = (
    "recognized_revenue estimated_product_cost estimated_gross_profit "
    "estimated_gross_margin_pct total_revenue_share_pct category_revenue_share_pct"
)


def view_statements() -> dict[str, str]:
    money = {
        "monthly_revenue": MONTHLY_MONEY,
        "category_performance": CATEGORY_MONEY,
        "customer_segments": SEGMENT_MONEY,
        "monthly_revenue_growth": GROWTH_MONEY,
        "customer_retention_cohorts": "",
        "product_performance": PRODUCT_MONEY,
        "monthly_order_status": "",
        "monthly_order_durations": "",
    }
    found = {v: statement(v, f"SELECT * FROM {v}", m) for v, m in money.items()}
    rounded = ", ".join(f"{r2(c)} AS {c}" for c in PRODUCT_MONEY.split()[:3])
    found["top_products"] = statement(
        "product_performance",
        f"""SELECT * REPLACE ({rounded}) FROM product_performance
            ORDER BY overall_revenue_rank, product_id LIMIT 50""",
        PRODUCT_MONEY,
    )
    return found


def audit_statements() -> dict[str, str]:
    before = ", ".join(
        f"{n_if(f'{b}_at < {a}_at')} AS {b}_before_{a}" for a, b in zip(EVENTS, EVENTS[1:])
    )
    after = {e: f"CAST({e}_at AS DATE) > {AS_OF}" for e in EVENTS}
    since = {e: f"CAST({e}_at AS DATE) >= {MONTH_START}" for e in EVENTS}
    left = "itm i LEFT JOIN prd p ON p.id = i.product_id"
    grades = (
        ("missing_end_orders", "no end"),
        ("incomplete_or_future_end_month_orders", "open"),
        ("missing_start_orders", "no start"),
        ("reversed_timestamp_orders", "reversed"),
        ("valid_duration_orders", "ok"),
    )

    def days(x: str) -> str:
        return f"CAST({r2(f'{x} / 86400.0::DOUBLE')} AS DOUBLE)"

    def in_period(condition: str) -> str:
        return n_if(f"created_at < {MONTH_START} AND {condition}")

    return {
        "orders_overview": statement("ord", f"""
            SELECT count(*) AS total_orders, count(DISTINCT order_id) AS unique_order_ids,
              count(DISTINCT user_id) AS unique_customers, {isum('num_of_item')} AS total_items,
              min(created_at) AS first_order_at, max(created_at) AS latest_order_at
            FROM ord"""),
        "order_status_counts": statement(
            "ord", "SELECT status, count(*) AS order_count FROM ord GROUP BY status"),
        "order_items_profile": statement("itm", f"""
            SELECT count(*) AS order_item_rows, count(DISTINCT id) AS unique_order_item_ids,
              count(DISTINCT order_id) AS unique_orders,
              count(DISTINCT product_id) AS unique_products,
              {msum('sale_price')} AS gross_item_value FROM itm""", "gross_item_value"),
        "product_join_coverage": statement("itm prd", f"""
            SELECT count(*) AS joined_rows, count(DISTINCT i.id) AS unique_order_item_ids,
              count(p.id) AS matched_product_rows, {n_if('p.id IS NULL')}
                AS unmatched_product_rows
            FROM {left}"""),
        "order_status_share": statement("ord", f"""
            SELECT status, count(*) AS orders,
              {pct('count(*)', '(SELECT count(*) FROM ord)')} AS order_share_pct
            FROM ord GROUP BY status""", "order_share_pct"),
        "item_status_share": statement("itm", f"""
            SELECT status, count(*) AS order_items, count(DISTINCT order_id) AS distinct_orders,
              {pct('count(*)', '(SELECT count(*) FROM itm)')} AS item_share_pct
            FROM itm GROUP BY status""", "item_share_pct"),
        "lifecycle_quality": statement("itm", f"""
            SELECT status, count(*) AS order_items,
              {', '.join(f"{n_if(f'{e}_at IS NULL')} AS missing_{e}_at" for e in EVENTS)},
              {before}
            FROM itm GROUP BY status"""),
        "event_date_coverage": statement("itm", f"""
            SELECT {', '.join(
                f"CAST({f}({e}_at) AS DATE) AS {label}_{e}_date"
                for e in EVENTS for f, label in (('min', 'first'), ('max', 'latest')))},
              {MONTH_START} AS current_month_start FROM itm"""),
        "future_and_current_counts": statement("itm", f"""
            SELECT count(*) AS order_item_rows,
              {', '.join(f"{n_if(after[e])} AS future_{e}_items" for e in EVENTS)},
              {', '.join(f"{n_if(since[e])} AS current_month_{e}_items" for e in EVENTS)}
            FROM itm"""),
        "key_uniqueness": statement("ord itm prd usr", """
            SELECT * FROM
              (SELECT count(*) AS order_rows, count(DISTINCT order_id) AS unique_order_ids
               FROM ord),
              (SELECT count(*) AS item_rows, count(DISTINCT id) AS unique_item_ids FROM itm),
              (SELECT count(*) AS product_rows, count(DISTINCT id) AS unique_product_ids
               FROM prd),
              (SELECT count(*) AS user_rows, count(DISTINCT id) AS unique_user_ids FROM usr)"""),
        "referential_integrity": statement("itm ord prd usr", f"""
            SELECT count(*) AS order_item_rows,
              {n_if('o.order_id IS NULL')} AS items_without_order,
              {n_if('p.id IS NULL')} AS items_without_product,
              {n_if('u.id IS NULL')} AS items_without_user,
              {n_if('i.user_id <> o.user_id')} AS item_order_user_mismatches,
              {n_if('i.status <> o.status')} AS item_order_status_mismatches
            FROM {left} LEFT JOIN ord o ON o.order_id = i.order_id
              LEFT JOIN usr u ON u.id = i.user_id"""),
        "price_cost_quality": statement("itm prd", f"""
            SELECT count(*) AS order_item_rows,
              {n_if('sale_price IS NULL')} AS missing_sale_price,
              {n_if('sale_price < 0')} AS negative_sale_price,
              {n_if('cost IS NULL')} AS missing_product_cost,
              {n_if('cost < 0')} AS negative_product_cost,
              {n_if('sale_price < cost')} AS items_sold_below_cost,
              {r2('min(sale_price)')} AS minimum_sale_price,
              {r2('max(sale_price)')} AS maximum_sale_price,
              {rdiv('sum(sale_price)', 'count(sale_price)')} AS average_sale_price
            FROM {left}""", "minimum_sale_price maximum_sale_price average_sale_price"),
        "price_distribution": statement("itm prd", f"""
            SELECT count(*) AS order_item_rows,
              {n_if('sale_price < 1')} AS items_below_one_dollar,
              {n_if('sale_price < 5')} AS items_below_five_dollars,
              {n_if('sale_price > 500')} AS items_above_five_hundred_dollars,
              {n_if('abs(sale_price - retail_price) > 0.01')} AS sale_retail_price_differences,
              {r2('quantile_disc(sale_price, 0.01)')} AS sale_price_p01,
              {r2('quantile_disc(sale_price, 0.5)')} AS sale_price_median,
              {r2('quantile_disc(sale_price, 0.99)')} AS sale_price_p99
            FROM itm i JOIN prd p ON p.id = i.product_id""",
            "sale_price_p01 sale_price_median sale_price_p99"),
        "item_count_reconciliation": statement("ord itm", f"""
            SELECT count(*) AS joined_orders, {n_if('num_of_item = n')} AS matching_item_counts,
              {n_if('num_of_item <> n')} AS mismatching_item_counts,
              max(abs(num_of_item - n)) AS largest_item_count_difference
            FROM ord JOIN (SELECT order_id, count(*) AS n FROM itm GROUP BY 1)
              USING (order_id)"""),
        "delivery_month_continuity": statement("month_series", f"""
            SELECT m AS month, orders AS completed_orders, items AS completed_items,
              {r2('revenue')} AS recognized_revenue, gap AS is_missing_delivery_month
            FROM month_series""", "recognized_revenue"),
        "retention_foundation": statement("sold", f"""
            SELECT count(*) AS customer_rows, count(DISTINCT user_id) AS unique_buyers,
              {n_if('user_id IS NULL')} AS missing_user_ids,
              {isum('n')} AS customer_month_rows,
              {n_if('n > 1')} AS customers_active_in_multiple_months,
              min(first_month) AS first_cohort_month, max(first_month) AS latest_cohort_month
            FROM (SELECT user_id, count(DISTINCT {month('delivered_at')}) AS n,
                    min({month('delivered_at')}) AS first_month FROM sold GROUP BY user_id)"""),
        "product_foundation": statement("sold prd", PRODUCT_FOUNDATION, FOUNDATION_MONEY),
        "order_operations_foundation": statement("ord", f"""
            SELECT *, eligible_orders = unique_order_ids AS one_row_per_order,
              eligible_orders = {' + '.join(f'{s.lower()}_orders' for s in STATUSES)}
                AS known_statuses_cover_all_orders,
              {', '.join(f"{dpct(f'{s}_orders', 'eligible_orders')} AS current_{s}_share_pct"
                         for s in ('cancelled', 'returned', 'complete'))}
            FROM (SELECT count(*) AS all_order_rows,
              {n_if('created_at IS NULL')} AS missing_created_at,
              {n_if(since['created'])} AS current_or_future_created_orders,
              {n_if(after['created'])} AS future_created_orders,
              {in_period('true')} AS eligible_orders,
              count(DISTINCT order_id) FILTER (WHERE created_at < {MONTH_START})
                AS unique_order_ids,
              CAST(min(created_at) FILTER (WHERE created_at < {MONTH_START}) AS DATE)
                AS first_created_date,
              CAST(max(created_at) FILTER (WHERE created_at < {MONTH_START}) AS DATE)
                AS latest_created_date,
              {', '.join(f'''{in_period(f"status = '{s}'")} AS {s.lower()}_orders'''
                         for s in STATUSES)},
              {in_period('status IS NULL')} AS missing_status,
              {in_period(f'status NOT IN {STATUSES}')} AS unexpected_status,
              {in_period("status = 'Complete' AND delivered_at IS NULL")}
                AS complete_without_delivery,
              {in_period("status = 'Returned' AND returned_at IS NULL")}
                AS returned_without_return_date,
              {', '.join(f"{in_period(f'{b}_at < {a}_at')} AS {b}_before_{a}"
                         for a, b in zip(EVENTS, EVENTS[1:]))},
              {', '.join(f"{in_period(after[e])} AS future_{e}_orders" for e in EVENTS[1:])}
              FROM ord)"""),
        "order_duration_foundation": statement("graded", f"""
            SELECT duration_type, count(*) AS candidate_orders,
              count(DISTINCT order_id) AS unique_candidate_order_ids,
              {', '.join(f'''{n_if(f"grade = '{g}'")} AS {name}''' for name, g in grades)},
              {n_if('secs = 0')} AS zero_duration_orders,
              CAST(min(e) FILTER (WHERE grade = 'ok') AS DATE) AS first_valid_end_date,
              CAST(max(e) FILTER (WHERE grade = 'ok') AS DATE) AS latest_valid_end_date,
              {days('min(secs)')} AS minimum_days,
              {days('(sum(secs) / NULLIF(CAST(count(secs) AS DOUBLE), 0))')} AS average_days,
              {days('quantile_disc(secs, 0.5)')} AS approximate_median_days,
              {days('quantile_disc(secs, 0.9)')} AS approximate_p90_days,
              {days('max(secs)')} AS maximum_days,
              count(*) = count(DISTINCT order_id) AS one_row_per_candidate_order,
              count(*) = count(grade) AS all_candidates_accounted_for
            FROM graded GROUP BY duration_type"""),
    }


PRODUCT_FOUNDATION = f"""
    SELECT count(*) AS completed_item_rows,
      count(DISTINCT s.id) AS unique_completed_item_ids,
      {n_if('p.id IS NULL')} AS unmatched_product_rows,
      {n_if("coalesce(trim(category), '') = ''")} AS missing_category_rows,
      {n_if("coalesce(trim(name), '') = ''")} AS missing_product_name_rows,
      {n_if('cost IS NULL')} AS missing_product_cost_rows,
      {n_if('cost < 0')} AS negative_product_cost_rows,
      {n_if('sale_price IS NULL')} AS missing_sale_price_rows,
      {n_if('sale_price < 0')} AS negative_sale_price_rows,
      count(DISTINCT category) AS categories, count(DISTINCT product_id) AS products_sold,
      {msum('sale_price')} AS source_recognized_revenue,
      {msum('sale_price - cost')} AS source_estimated_gross_profit
    FROM sold s LEFT JOIN prd p ON p.id = s.product_id"""
FOUNDATION_MONEY = "source_recognized_revenue source_estimated_gross_profit"

SPAN = "date_diff('month', first_month, latest_month) + 1"


def _grain(view: str, column: str, extra: str) -> str:
    return f"""SELECT count(*) AS monthly_rows, count(DISTINCT {column}) AS unique_months,
        min({column}) AS first_month, max({column}) AS latest_month, {extra} FROM {view}"""


def _totals(view: str) -> str:
    return f"""SELECT {isum('completed_orders')} AS completed_orders,
        {isum('completed_items')} AS completed_items,
        {msum('recognized_revenue')} AS recognized_revenue FROM {view}"""


def check_selects() -> dict[str, tuple[str, str, str]]:
    """Subqueries read, select and money columns of each check."""
    complete = f"latest_month < {MONTH_START} AS latest_month_is_complete"
    names = ("completed_orders", "completed_items", "recognized_revenue")

    def arithmetic(label: str, previous: str) -> str:
        change = f"recognized_revenue - {previous}"
        return f"""
            {n_if(f'abs({label}_revenue_change - {r2(change)}) > 0.01')}
              AS {label}_change_mismatches,
            {n_if(f'abs({label}_growth_pct - {pct(change, previous)}) > 0.01')}
              AS {label}_growth_mismatches"""

    def rolling(n: int) -> str:
        base = f"rolling_{n}_month"
        rebuilt = f"CASE WHEN h.n{n} = {n} THEN {{}} END"
        total = rebuilt.format(f"h.s{n}")
        mean = rebuilt.format(rdiv(f"h.s{n}", str(n)))

        def off(a: str, b: str) -> str:
            return n_if(f"({a} IS NULL) <> ({b} IS NULL) OR abs({a} - {b}) > 0.01")

        return f"""{off(f'g.{base}_revenue', total)} AS rolling_{n}_revenue_mismatches,
            {off(f'g.{base}_average_revenue', mean)} AS rolling_{n}_average_mismatches"""

    product_sums = f"""
        SELECT count(*) AS product_rows, count(DISTINCT product_id) AS unique_products,
          {isum('completed_items')} AS product_items,
          {msum('recognized_revenue')} AS product_revenue,
          {msum('estimated_gross_profit')} AS product_gross_profit"""
    item_sums = f"""
        SELECT count(*) AS source_items, count(DISTINCT product_id) AS source_products,
          {msum('sale_price')} AS source_revenue, {msum('profit')} AS source_gross_profit
        FROM sold_products"""

    def compared(view: str) -> str:
        return f"""
            SELECT count(*) AS categories_compared, {n_if('''(x.category = c.category) IS NOT TRUE
                OR x.items <> c.completed_items
                OR greatest(abs(x.revenue - c.recognized_revenue),
                            abs(x.profit - c.estimated_gross_profit)) > 0.01''')}
              AS category_mismatches
            FROM (SELECT category, sum(completed_items) AS items,
                    sum(recognized_revenue) AS revenue, sum(estimated_gross_profit) AS profit
                  FROM {view} GROUP BY category) x
            FULL JOIN category_performance c ON x.category = c.category"""

    def product_check(view: str, extra_sums: str, extra: str, flag: str) -> str:
        return f"""
            SELECT product_rows, unique_products, source_products, product_items, source_items,
              product_revenue, source_revenue, product_gross_profit, source_gross_profit, {extra}
              categories_compared, category_mismatches,
              product_rows = unique_products AS one_row_per_product,
              (product_rows, product_items, product_revenue, product_gross_profit)
                = (source_products, source_items, source_revenue, source_gross_profit) AS {flag},
              category_mismatches = 0 AS categories_match_existing_view
            FROM ({product_sums} {extra_sums} FROM {view}), ({item_sums}), ({compared(view)})"""

    product_money = "product_revenue source_revenue product_gross_profit source_gross_profit"
    retention_counts = f"""
        SELECT count(*) AS cohort_month_rows, count(DISTINCT cohort_month) AS cohort_months,
          {isum('cohort_customers) FILTER (WHERE months_since_first_purchase = 0')}
            AS cohort_size_total,
          {n_if('months_since_first_purchase = 0')} AS month_zero_rows,
          {n_if('months_since_first_purchase > 0 AND active_customers > 0')}
            AS nonzero_return_rows,
          count(*) - (SELECT count(*) FROM (SELECT DISTINCT cohort_month,
            months_since_first_purchase FROM customer_retention_cohorts))
            AS duplicate_cohort_age_rows,
          {n_if('months_since_first_purchase = 0 AND active_customers <> cohort_customers')}
            AS month_zero_customer_mismatches,
          {n_if('months_since_first_purchase = 0 AND retention_pct <> 100')}
            AS month_zero_retention_mismatches,
          {n_if('NOT (active_customers BETWEEN 0 AND cohort_customers)')}
            AS invalid_active_customer_rows,
          {n_if('NOT (months_since_first_purchase BETWEEN 0 AND 12)')}
            AS invalid_cohort_age_rows,
          {n_if('''date_diff('month', cohort_month, activity_month)
                   <> months_since_first_purchase''')} AS activity_month_mismatches,
          {n_if(f'activity_month >= {MONTH_START}')} AS incomplete_or_future_month_rows,
          {n_if(f"retention_pct <> {dpct('active_customers', 'cohort_customers')}")}
            AS retention_calculation_mismatches
        FROM customer_retention_cohorts"""
    retention_flags = """
        month_zero_rows = cohort_months AS one_month_zero_row_per_cohort,
        cohort_size_total = source_unique_buyers AS cohort_sizes_match_buyers"""
    source_cohorts = f"""
        SELECT {isum('size')} AS source_unique_buyers, sum(oldest + 1) AS expected
        FROM cohort_sizes"""
    shares = ", ".join(
        f"{n_if(f'''current_{s}_share_pct IS DISTINCT FROM '''
                + dpct(f'{s}_orders', 'created_orders'))} AS {s}_share_mismatches"
        for s in ("cancelled", "returned", "complete")
    )
    statuses = " + ".join(f"{s.lower()}_orders" for s in STATUSES)
    return {
        "reconcile_reporting_views": (
            "monthly_revenue category_performance customer_segments",
            f"""SELECT latest_reported_month,
                latest_reported_month < {MONTH_START} AS latest_month_is_complete,
                monthly_orders, customer_orders, monthly_orders = customer_orders AS orders_match,
                monthly_items, category_items, monthly_items = category_items AS items_match,
                monthly_revenue, category_revenue,
                monthly_revenue = category_revenue AS category_revenue_matches,
                customer_revenue, monthly_revenue = customer_revenue AS customer_revenue_matches,
                customer_count
            FROM (SELECT max(revenue_month) AS latest_reported_month,
                    {isum('completed_orders')} AS monthly_orders,
                    {isum('completed_items')} AS monthly_items,
                    {msum('recognized_revenue')} AS monthly_revenue FROM monthly_revenue),
                 (SELECT {isum('completed_items')} AS category_items,
                    {msum('recognized_revenue')} AS category_revenue FROM category_performance),
                 (SELECT {isum('customers')} AS customer_count,
                    {isum('completed_orders')} AS customer_orders,
                    {msum('recognized_revenue')} AS customer_revenue FROM customer_segments)""",
            "monthly_revenue category_revenue customer_revenue",
        ),
        "growth_grain_check": (
            "monthly_revenue_growth",
            f"""SELECT * EXCLUDE (a, b, c, d), {SPAN} AS expected_calendar_months,
                monthly_rows = unique_months AS one_row_per_month,
                monthly_rows = {SPAN} AS calendar_is_continuous, {complete},
                a AS null_previous_month_rows, b AS null_previous_year_rows,
                c AS null_rolling_3_rows, d AS null_rolling_12_rows
            FROM ({_grain('monthly_revenue_growth', 'revenue_month', ', '.join(
                f'count(*) - count({c}) AS {a}' for a, c in (
                    ('a', 'previous_month_revenue'), ('b', 'previous_year_revenue'),
                    ('c', 'rolling_3_month_revenue'), ('d', 'rolling_12_month_revenue'))))})""",
            "",
        ),
        "growth_vs_monthly": (
            "monthly_revenue monthly_revenue_growth",
            f"""SELECT {', '.join(
                f'e.{c} AS existing_{c}, g.{c} AS growth_{c}, e.{c} = g.{c} AS '
                + (f'{c}_matches' if 'revenue' in c else f'{c}_match') for c in names)}
            FROM ({_totals('monthly_revenue')}) e, ({_totals('monthly_revenue_growth')}) g""",
            "existing_recognized_revenue growth_recognized_revenue",
        ),
        "growth_view_check": (
            "monthly_revenue monthly_revenue_growth",
            f"""SELECT monthly_rows, unique_months, first_month, latest_month,
                monthly_rows = unique_months AS one_row_per_month,
                monthly_rows = {SPAN} AS calendar_is_continuous, {complete},
                {', '.join(f'g.{c}' for c in names)}, {', '.join(
                f'e.{c} = g.{c} AS ' + (f'{c}_matches' if 'revenue' in c else f'{c}_match')
                for c in names)}
            FROM ({_grain('monthly_revenue_growth', 'revenue_month', '0 AS unused')}),
              ({_totals('monthly_revenue')}) e, ({_totals('monthly_revenue_growth')}) g""",
            "recognized_revenue",
        ),
        "growth_arithmetic_check": (
            "monthly_revenue_growth",
            f"""SELECT {n_if('abs(average_order_value - '
                             + rdiv('recognized_revenue', 'completed_orders') + ') > 0.01')}
                AS average_order_value_mismatches,
                {arithmetic('month_over_month', 'previous_month_revenue')},
                {arithmetic('year_over_year', 'previous_year_revenue')}
            FROM monthly_revenue_growth""",
            "",
        ),
        "rolling_window_check": (
            "monthly_revenue_growth",
            f"""SELECT {rolling(3)}, {rolling(12)} FROM monthly_revenue_growth g JOIN (
                SELECT now.revenue_month, count(*) AS n12, {msum('past.recognized_revenue')} AS s12,
                  {n_if('past.revenue_month >= now.revenue_month - INTERVAL 2 MONTH')} AS n3,
                  {r2('''sum(past.recognized_revenue) FILTER (
                       WHERE past.revenue_month >= now.revenue_month - INTERVAL 2 MONTH)''')}
                    AS s3
                FROM monthly_revenue_growth now JOIN monthly_revenue_growth past
                  ON past.revenue_month BETWEEN now.revenue_month - INTERVAL 11 MONTH
                    AND now.revenue_month
                GROUP BY now.revenue_month) h USING (revenue_month)""",
            "",
        ),
        "cohort_start_check": (
            "itm monthly_revenue monthly_revenue_growth",
            f"""SELECT c.m AS month, coalesce(items, 0) AS source_completed_items,
                coalesce(orders, 0) AS source_completed_orders,
                coalesce(buyers, 0) AS source_unique_buyers,
                coalesce(nobody, 0) AS source_missing_user_ids,
                coalesce(revenue, 0) AS source_recognized_revenue,
                r.completed_items AS existing_view_completed_items,
                r.recognized_revenue AS existing_view_revenue,
                g.completed_items AS growth_view_completed_items,
                g.recognized_revenue AS growth_view_revenue
            FROM (VALUES (DATE '1994-12-01'), (DATE '1995-01-01'), (DATE '1995-02-01'),
                         (DATE '1995-03-01')) c(m)
            LEFT JOIN (SELECT {month('delivered_at')} AS m, count(*) AS items,
                count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS buyers,
                {n_if('user_id IS NULL')} AS nobody, {msum('sale_price')} AS revenue
              FROM itm WHERE status = 'Complete' GROUP BY 1) s ON s.m = c.m
            LEFT JOIN monthly_revenue r ON r.revenue_month = c.m
            LEFT JOIN monthly_revenue_growth g ON g.revenue_month = c.m""",
            "source_recognized_revenue existing_view_revenue growth_view_revenue",
        ),
        "retention_check": (
            "customer_retention_cohorts",
            f"""SELECT cohort_month_rows, cohort_months, source_unique_buyers, cohort_size_total,
                month_zero_rows, nonzero_return_rows,
                cohort_month_rows = expected AS expected_spine_rows_match, {retention_flags},
                duplicate_cohort_age_rows, month_zero_customer_mismatches,
                month_zero_retention_mismatches, invalid_active_customer_rows,
                invalid_cohort_age_rows, activity_month_mismatches,
                incomplete_or_future_month_rows, retention_calculation_mismatches,
                cohorts_with_changing_size
            FROM ({retention_counts}), ({source_cohorts}),
              (SELECT count(*) AS cohorts_with_changing_size FROM (
                SELECT cohort_month FROM customer_retention_cohorts GROUP BY 1
                HAVING count(DISTINCT cohort_customers) > 1))""",
            "",
        ),
        "retention_view_check": (
            "customer_retention_cohorts",
            f"""SELECT cohort_month_rows, cohort_months, cohort_size_total, source_unique_buyers,
                cohort_month_rows = expected AS expected_rows_match, {retention_flags},
                duplicate_cohort_age_rows, month_zero_customer_mismatches,
                month_zero_retention_mismatches, invalid_active_customer_rows,
                invalid_cohort_age_rows, incomplete_or_future_month_rows,
                retention_calculation_mismatches
            FROM ({retention_counts}), ({source_cohorts})""",
            "",
        ),
        "product_foundation_reconcile": (
            "sold prd monthly_revenue category_performance",
            f"""SELECT *, completed_item_rows = unique_completed_item_ids AS one_row_per_item,
                completed_item_rows = monthly_view_items
                  AND abs(source_recognized_revenue - monthly_view_revenue) <= 0.05
                  AS monthly_view_matches_source,
                completed_item_rows = category_view_items
                  AND greatest(abs(source_recognized_revenue - category_view_revenue),
                    abs(source_estimated_gross_profit - category_view_estimated_gross_profit))
                    <= 0.05 AS category_view_matches_source
            FROM ({PRODUCT_FOUNDATION}),
              (SELECT {isum('completed_items')} AS monthly_view_items,
                {msum('recognized_revenue')} AS monthly_view_revenue FROM monthly_revenue),
              (SELECT {isum('completed_items')} AS category_view_items,
                {msum('recognized_revenue')} AS category_view_revenue,
                {msum('estimated_gross_profit')} AS category_view_estimated_gross_profit
               FROM category_performance)""",
            FOUNDATION_MONEY + " monthly_view_revenue category_view_revenue "
            "category_view_estimated_gross_profit",
        ),
        "product_reconcile": (
            "by_product category_performance",
            product_check("by_product", "", "", "product_totals_match_source"),
            product_money,
        ),
        "product_view_reconcile": (
            "product_performance category_performance",
            product_check(
                "product_performance",
                f""", {n_if('product_id IS NULL OR product_name IS NULL OR category IS NULL')}
                    AS missing_product_attributes,
                  {n_if('overall_revenue_rank < 1 OR category_revenue_rank < 1')}
                    AS invalid_ranks""",
                "missing_product_attributes, invalid_ranks,",
                "product_view_matches_source",
            ),
            product_money,
        ),
        "status_check": (
            "monthly_order_status",
            f"""SELECT *, monthly_rows = unique_months AS one_row_per_month,
                monthly_rows = {SPAN} AS calendar_is_continuous,
                monthly_order_total = source_order_total AS orders_match_source
            FROM ({_grain('monthly_order_status', 'created_month', f'''
                {isum('created_orders')} AS monthly_order_total,
                {n_if(f'created_month >= {MONTH_START}')} AS incomplete_or_future_months,
                {n_if(f'created_orders <> {statuses}')} AS status_count_mismatches,
                {n_if('currently_open_orders <> processing_orders + shipped_orders')}
                  AS open_count_mismatches, {shares}''')}),
              (SELECT count(*) AS source_order_total FROM ord
               WHERE created_at < {MONTH_START})""",
            "",
        ),
        "duration_check": (
            "monthly_order_durations spans",
            f"""SELECT coalesce(v.duration_type, x.t) AS duration_type,
                count(*) AS compared_month_rows,
                count(DISTINCT event_month) AS unique_output_months,
                min(event_month) AS first_event_month, max(event_month) AS latest_event_month,
                {isum('valid_duration_orders')} AS output_valid_orders,
                {isum('x.ok')} AS source_valid_orders,
                {n_if('event_month IS NULL OR x.m IS NULL')} AS missing_or_extra_months,
                count(*) - count(DISTINCT event_month) AS duplicate_or_missing_month_rows,
                {n_if(f'event_month >= {MONTH_START}')} AS incomplete_or_future_months,
                {n_if('''(ended_orders, valid_duration_orders)
                         IS DISTINCT FROM (x.n, x.ok)''')} AS source_count_mismatches,
                {n_if('''ended_orders IS DISTINCT FROM valid_duration_orders
                         + missing_start_orders + reversed_timestamp_orders''')}
                  AS accounting_mismatches,
                {n_if('NOT (zero_duration_orders BETWEEN 0 AND valid_duration_orders)')}
                  AS invalid_zero_counts,
                {n_if('valid_duration_share_pct IS DISTINCT FROM '
                      + dpct('valid_duration_orders', 'ended_orders'))} AS coverage_mismatches,
                {n_if('average_days IS DISTINCT FROM CAST('
                      + rdiv('total_elapsed_days', 'valid_duration_orders') + ' AS DOUBLE)')}
                  AS average_mismatches,
                {n_if('''(total_elapsed_days IS NULL) <> (x.days IS NULL)
                         OR abs(total_elapsed_days - x.days) > 1e-6''')}
                  AS elapsed_total_mismatches,
                {n_if('''CASE WHEN valid_duration_orders > 0 THEN coalesce(NOT (
                    0 <= approximate_median_days
                    AND approximate_median_days <= approximate_p90_days
                    AND approximate_p90_days <= maximum_days
                    AND average_days BETWEEN 0 AND maximum_days), true)
                  ELSE coalesce(average_days, approximate_median_days,
                    approximate_p90_days, maximum_days) IS NOT NULL END''')}
                  AS invalid_duration_summary_rows
            FROM monthly_order_durations v FULL JOIN (
              SELECT duration_type AS t, {month('e')} AS m, count(*) AS n,
                {n_if('s <= e')} AS ok,
                sum(date_sub('second', s, e)) FILTER (WHERE s <= e) / 86400.0::DOUBLE AS days
              FROM spans WHERE e < {MONTH_START} GROUP BY 1, 2) x
              ON v.duration_type = x.t AND v.event_month = x.m
            GROUP BY 1""",
            "",
        ),
    }


def check_statements() -> dict[str, str]:
    return {n: statement(r, s, m) for n, (r, s, m) in check_selects().items()}


def dashboard_statements() -> dict[str, str]:
    months, categories = "monthly_revenue", "category_performance"
    return {
        "kpi_recognized_revenue": statement(
            months, f"SELECT sum(recognized_revenue) AS recognized_revenue FROM {months}",
            "recognized_revenue"),
        "kpi_completed_orders": statement(
            months, f"SELECT {isum('completed_orders')} AS completed_orders FROM {months}"),
        "kpi_average_order_value": statement(months, f"""
            SELECT {div('sum(recognized_revenue)', 'sum(completed_orders)')}
              AS average_order_value FROM {months}"""),
        "kpi_gross_margin": statement(categories, f"""
            SELECT {div('sum(estimated_gross_profit)', 'sum(recognized_revenue)')}
              AS gross_margin FROM {categories}"""),
        "monthly_revenue_trend": statement(months, f"""
            SELECT revenue_month, recognized_revenue, completed_orders, average_order_value,
              revenue_growth_pct FROM {months}""",
            "recognized_revenue average_order_value revenue_growth_pct"),
        "top_categories": statement(
            categories, f"SELECT * FROM {categories} WHERE revenue_rank <= 10", CATEGORY_MONEY),
        "segment_distribution": statement(
            "customer_segments", "SELECT * FROM customer_segments", SEGMENT_MONEY),
    }


# Rules that are counts, next to the flags, in the combined list.
ZERO_RULES = {
    "growth_arithmetic": ("growth_arithmetic_check", """
        average_order_value_mismatches month_over_month_change_mismatches
        month_over_month_growth_mismatches year_over_year_change_mismatches
        year_over_year_growth_mismatches"""),
    "rolling_windows": ("rolling_window_check", """
        rolling_3_revenue_mismatches rolling_3_average_mismatches
        rolling_12_revenue_mismatches rolling_12_average_mismatches"""),
    "retention": ("retention_check", """
        duplicate_cohort_age_rows month_zero_customer_mismatches
        month_zero_retention_mismatches invalid_active_customer_rows invalid_cohort_age_rows
        activity_month_mismatches incomplete_or_future_month_rows
        retention_calculation_mismatches cohorts_with_changing_size"""),
    "product_totals": ("product_reconcile", "category_mismatches"),
    "products": ("product_view_reconcile", """
        invalid_ranks category_mismatches missing_product_attributes"""),
    "order_status": ("status_check", """
        incomplete_or_future_months status_count_mismatches open_count_mismatches
        cancelled_share_mismatches returned_share_mismatches complete_share_mismatches"""),
    "order_durations": ("duration_check", """
        missing_or_extra_months duplicate_or_missing_month_rows incomplete_or_future_months
        source_count_mismatches accounting_mismatches invalid_zero_counts coverage_mismatches
        average_mismatches elapsed_total_mismatches invalid_duration_summary_rows"""),
}
FLAG_RULES = {
    "reporting_views": ("reconcile_reporting_views", """
        latest_month_is_complete orders_match items_match category_revenue_matches
        customer_revenue_matches"""),
    "growth_grain": ("growth_grain_check", """
        one_row_per_month calendar_is_continuous latest_month_is_complete"""),
    "growth_vs_monthly": ("growth_vs_monthly", """
        completed_orders_match completed_items_match recognized_revenue_matches"""),
    "retention": ("retention_check", """
        expected_spine_rows_match one_month_zero_row_per_cohort cohort_sizes_match_buyers"""),
    "product_foundation": ("product_foundation_reconcile", """
        one_row_per_item monthly_view_matches_source category_view_matches_source"""),
    "product_totals": ("product_reconcile", """
        one_row_per_product product_totals_match_source categories_match_existing_view"""),
    "order_foundation": ("order_foundation", """
        one_row_per_order known_statuses_cover_all_orders"""),
    "duration_foundation": ("duration_foundation", """
        one_row_per_candidate_order all_candidates_accounted_for"""),
    "products": ("product_view_reconcile", """
        one_row_per_product product_view_matches_source categories_match_existing_view"""),
    "order_status": ("status_check", """
        one_row_per_month calendar_is_continuous orders_match_source"""),
}


def validation_statement() -> str:
    """Every rule of every check as check_name, scope, metric, value, passed."""
    selects = check_selects() | {
        "order_foundation": (
            "ord",
            f"""SELECT count(*) = count(DISTINCT order_id) AS one_row_per_order,
                count(*) = {n_if(f"status IN {STATUSES}")} AS known_statuses_cover_all_orders
            FROM ord WHERE created_at < {MONTH_START}""",
            "",
        ),
        "duration_foundation": (
            "graded",
            f"""SELECT duration_type,
                count(*) = count(DISTINCT order_id) AS one_row_per_candidate_order,
                count(*) = count(grade) AS all_candidates_accounted_for
            FROM graded GROUP BY duration_type""",
            "",
        ),
    }
    used = {c for c, _ in [*ZERO_RULES.values(), *FLAG_RULES.values()]}
    reads = " ".join(selects[c][0] for c in used)
    rows = []
    for rules, passed in ((ZERO_RULES, "{} = 0"), (FLAG_RULES, "{}")):
        for label, (check, metrics) in rules.items():
            scope = "duration_type" if check.startswith("duration_") else "'all'"
            rows += [
                f"SELECT '{label}' AS check_name, {scope} AS scope, '{m}' AS metric, "
                f"CAST({m} AS VARCHAR) AS value, coalesce({passed.format(m)}, false) AS passed "
                f"FROM done_{check}"
                for m in metrics.split()
            ]
    named = ",\n".join(f"{n} AS ({PARTS[n]})" for n in _ordered(reads.split(), []))
    done = ",\n".join(f"done_{c} AS ({selects[c][1]})" for c in sorted(used))
    return f"WITH {named},\n{done}\n" + "\nUNION ALL\n".join(rows)


# The state of orders and items at the end of 10 June 2001, from the times of events.
KNOWN = "TIMESTAMP '2001-06-11'"
KNOWN_STATUS = f"""
    CASE WHEN status IN ('Returned', 'Complete', 'Shipped') AND shipped_at >= {KNOWN}
              AND (status = 'Shipped' OR delivered_at >= {KNOWN})
              AND (status <> 'Returned' OR returned_at >= {KNOWN}) THEN 'Processing'
         WHEN status IN ('Returned', 'Complete') AND delivered_at >= {KNOWN}
              AND (status = 'Complete' OR returned_at >= {KNOWN}) THEN 'Shipped'
         WHEN status = 'Returned' AND returned_at >= {KNOWN} THEN 'Complete'
         ELSE status END AS status"""
KNOWN_EVENTS = ", ".join(
    f"CASE WHEN {e}_at < {KNOWN} THEN {e}_at END AS {e}_at" for e in EVENTS[1:]
)


def known(part: str) -> str:
    """Orders or items as they were known then."""
    replaced = ", ".join(c for c in [KNOWN_STATUS, KNOWN_EVENTS])
    return f"""SELECT * REPLACE ({replaced}) FROM {part}
        WHERE created_at IS NULL OR created_at < {KNOWN}"""


def earlier(name: str) -> str:
    """A subquery over the earlier state; the subqueries it reads are renamed alike."""
    if name in ("ord", "itm"):
        return known(name)
    renamed = set(_ordered([name], [])) & EARLIER
    words = "|".join(sorted(renamed, key=len, reverse=True))
    return re.sub(rf"\b(FROM|JOIN)(\s+)({words})\b", r"\1\2known_\3", PARTS[name])


def _reach_orders() -> set[str]:
    """The subqueries that read orders or items, and these two."""
    return {
        n
        for n in [*READS, "ord", "itm"]
        if n not in ("sent", "arrived", "parents") and {"ord", "itm"} & set(_ordered([n], []))
    }


EARLIER = _reach_orders()


def drift_statement() -> str:
    """Totals of the views of two runs: one over the earlier state, one over the present."""
    totals = {
        "monthly_revenue": "completed_orders completed_items recognized_revenue",
        "category_performance": "completed_items recognized_revenue estimated_gross_profit",
        "customer_segments": "customers completed_orders recognized_revenue",
        "monthly_revenue_growth": "completed_orders completed_items recognized_revenue",
        "customer_retention_cohorts": "cohort_customers active_customers",
        "product_performance": "completed_items recognized_revenue estimated_gross_profit",
        "monthly_order_status": "created_orders currently_open_orders",
        "monthly_order_durations": "ended_orders valid_duration_orders",
    }
    parts = _ordered(list(totals), [])
    named = [f"{n} AS ({PARTS[n]})" for n in parts]
    named += [f"known_{n} AS ({earlier(n)})" for n in parts if n in EARLIER]
    rows = " UNION ALL ".join(
        f"""SELECT '{view}' AS view_name, '{m}' AS metric,
              (SELECT CAST(sum({m}) AS DOUBLE) FROM known_{view}) AS earlier_value,
              (SELECT CAST(sum({m}) AS DOUBLE) FROM {view}) AS later_value"""
        for view, metrics in totals.items()
        for m in metrics.split()
    )
    return f"""WITH {", ".join(named)}
        SELECT *, earlier_value IS DISTINCT FROM later_value AS drifted FROM ({rows})"""


def location_statement() -> str:
    """Items of two states compared row by row, without checksums."""
    sides = " UNION ALL ".join(
        f"""SELECT {month('created_at')} AS month, CAST(created_at AS DATE) AS day, id,
              {side} AS side, count(*) AS n, string_agg(body, ',' ORDER BY body) AS body
            FROM (SELECT created_at, id, CAST({part} AS VARCHAR) AS body FROM {part})
            GROUP BY ALL"""
        for side, part in ((1, "known_itm"), (2, "itm"))
    )
    reads = ", ".join(f"{n} AS ({PARTS[n]})" for n in _ordered(["itm"], []))
    return f"""
        WITH {reads}, known_itm AS ({earlier('itm')}),
        keys AS (
          SELECT month, day, id, coalesce(sum(n) FILTER (WHERE side = 1), 0) AS a,
            coalesce(sum(n) FILTER (WHERE side = 2), 0) AS b,
            max(body) FILTER (WHERE side = 1)
              IS DISTINCT FROM max(body) FILTER (WHERE side = 2) AS differs
          FROM ({sides}) GROUP BY month, day, id),
        days AS (SELECT month, day, sum(a) AS a, sum(b) AS b, bool_or(differs) AS differs
                 FROM keys GROUP BY month, day),
        months AS (SELECT month, sum(a) AS a, sum(b) AS b, bool_or(differs) AS differs
                   FROM days GROUP BY month),
        listed AS (
          SELECT 'month' AS level, month, NULL::DATE AS day, NULL AS id, 'none' AS change, a, b
          FROM months WHERE NOT differs
          UNION ALL
          SELECT 'day', d.month, d.day, NULL, 'none', d.a, d.b
          FROM days d JOIN months m ON d.month IS NOT DISTINCT FROM m.month
          WHERE m.differs AND NOT d.differs
          UNION ALL
          SELECT 'key', month, day, id,
            CASE WHEN a = 0 THEN 'added' WHEN b = 0 THEN 'removed' ELSE 'changed' END, a, b
          FROM keys WHERE differs)
        SELECT level, month, day, id, change, CAST(a AS BIGINT) AS earlier_rows,
          CAST(b AS BIGINT) AS later_rows FROM listed"""


def yearly_points_statement() -> str:
    """Exact price percentiles per year; the sketches have to be close to them."""
    points = ", ".join(
        f"CAST({r2(f'quantile_disc(sale_price, {p})')} AS DOUBLE) AS {name}"
        for name, p in (("price_p01", 0.01), ("price_median", 0.5), ("price_p99", 0.99))
    )
    return statement("itm", f"""
        SELECT CAST(date_part('year', created_at) AS INTEGER) AS year,
          count(*) AS priced_items, {points}, true AS sketch_within_bound
        FROM itm WHERE sale_price IS NOT NULL AND created_at IS NOT NULL GROUP BY 1""")


def statements() -> dict[str, str]:
    views = view_statements()
    return {
        **views,
        **audit_statements(),
        **check_statements(),
        **dashboard_statements(),
        "validate_all": validation_statement(),
        "yearly_price_points": yearly_points_statement(),
        "validate_deployed": validation_statement(),
        "snapshot_drift": drift_statement(),
        "drift_location": location_statement(),
        "refreshed_revenue": views["monthly_revenue"],
        "refreshed_growth": views["monthly_revenue_growth"],
        "refreshed_status": views["monthly_order_status"],
        "refreshed_durations": views["monthly_order_durations"],
    }
