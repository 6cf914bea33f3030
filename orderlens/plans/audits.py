"""Source profiles and foundation checks, run before the views are trusted."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.dates import (
    after_day,
    in_complete_month,
    in_open_month,
    month_of,
    month_start,
)
from orderlens.functions.numbers import (
    count_if,
    money,
    pct,
    ratio,
    ratio2,
    round2,
    sum_if,
    times,
)
from orderlens.operators.calendar import fill_months
from orderlens.operators.durations import (
    MIDDLE,
    MISSING_END,
    MISSING_START,
    OPEN_END,
    REVERSED,
    SECONDS_PER_DAY,
    VALID,
    classified_durations,
)
from orderlens.operators.hotkeys import join_parents
from orderlens.operators.ordering import approximate_quantiles, magnitude, quantiles
from orderlens.operators.rows import one_row, recognized_items, with_copies
from orderlens.operators.sketches import RANK_ERROR, merged, monthly_sketches, points
from orderlens.plans.views import STATUSES, recognized_by_month
from orderlens.sources import RetailTables

# Fixed value: the four lifecycle events, in order.
EVENTS = ("created", "shipped", "delivered", "returned")


def _precedes(later: str, earlier: str) -> Column:
    return F.col(f"{later}_at") < F.col(f"{earlier}_at")


def _reversed_events() -> list[Column]:
    return [
        count_if(_precedes(later, earlier)).alias(f"{later}_before_{earlier}")
        for earlier, later in zip(EVENTS, EVENTS[1:])
    ]


# --- volume and status profiles -------------------------------------------


# A scan that counts one kind of distinct value reads only that column and
# combines equal values before the shuffle; several kinds in one scan would
# multiply every row instead.
def _distinct(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(name))


def orders_overview(orders: DataFrame) -> DataFrame:
    return one_row(
        orders.agg(
            F.count("*").alias("total_orders"),
            F.countDistinct("order_id").alias("unique_order_ids"),
            F.sum("num_of_item").alias("total_items"),
            F.min("created_at").alias("first_order_at"),
            F.max("created_at").alias("latest_order_at"),
        ),
        _distinct(orders, "user_id", "unique_customers"),
    ).select(
        "total_orders",
        "unique_order_ids",
        "unique_customers",
        "total_items",
        "first_order_at",
        "latest_order_at",
    )


def order_status_counts(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("status").agg(F.count("*").alias("order_count"))
    return counts.orderBy(F.desc("order_count"))


def order_items_profile(items: DataFrame) -> DataFrame:
    """Item-table size and gross item value, whatever the status."""
    return one_row(
        items.agg(
            F.count("*").alias("order_item_rows"),
            F.countDistinct("order_id").alias("unique_orders"),
            round2(F.sum(money(items, "sale_price"))).alias("gross_item_value"),
        ),
        _distinct(items, "id", "unique_order_item_ids"),
        _distinct(items, "product_id", "unique_products"),
    ).select(
        "order_item_rows",
        "unique_order_item_ids",
        "unique_orders",
        "unique_products",
        "gross_item_value",
    )


def _with_share(counts: DataFrame, count: str, share: str) -> DataFrame:
    # One row per status.
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(share, pct(F.col(count), total)).orderBy(F.desc(count))


def order_status_share(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("status").agg(F.count("*").alias("orders"))
    return _with_share(counts, "orders", "order_share_pct")


def item_status_share(items: DataFrame) -> DataFrame:
    counts = items.groupBy("status").agg(
        F.count("*").alias("order_items"),
        F.countDistinct("order_id").alias("distinct_orders"),
    )
    return _with_share(counts, "order_items", "item_share_pct")


# --- schema, keys and relations -------------------------------------------


def schema_profile(tables: RetailTables) -> DataFrame:
    """Columns, positions, types and nullability of the four tables."""
    rows = [
        (name, position, field.name, field.dataType.simpleString(), field.nullable)
        for name, df in sorted(tables.named().items())
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return tables.orders.sparkSession.createDataFrame(
        rows,
        "table_name string, ordinal_position bigint, column_name string, "
        "data_type string, is_nullable boolean",
    ).orderBy("table_name", "ordinal_position")


def key_uniqueness(tables: RetailTables) -> DataFrame:
    """Rows against distinct keys of each table."""

    def counts(df: DataFrame, key: str, label: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"{label}_rows"),
            F.countDistinct(key).alias(f"unique_{label}_ids"),
        )

    return one_row(
        counts(tables.orders, "order_id", "order"),
        counts(tables.order_items, "id", "item"),
        counts(tables.products, "id", "product"),
        counts(tables.users, "id", "user"),
    )


def product_join_coverage(items: DataFrame, products: DataFrame) -> DataFrame:
    """How many rows an item-to-product left join yields and matches.

    Items are counted per product first, so no product is a hot join key.
    """
    sold = items.groupBy("product_id").agg(F.count("*").alias("rows"))
    known = with_copies(products, F.col("id").alias("known_product"))
    joined = sold.join(known, F.col("product_id") == F.col("known_product"), "left")
    rows, copies = F.col("rows"), F.col("copies")
    counts = joined.agg(
        F.coalesce(F.sum(rows * F.coalesce(copies, F.lit(1))), F.lit(0)).alias("joined_rows"),
        sum_if(copies.isNotNull(), rows * copies).alias("matched_product_rows"),
        sum_if(copies.isNull(), rows).alias("unmatched_product_rows"),
    )
    # A left join keeps every item, so its distinct ids are those of the items.
    ids = _distinct(items, "id", "unique_order_item_ids")
    return one_row(counts, ids).select(
        "joined_rows", "unique_order_item_ids", "matched_product_rows", "unmatched_product_rows"
    )


def referential_integrity(tables: RetailTables) -> DataFrame:
    """Items without a parent row, and items that disagree with their order.

    Repeated parent rows are joined as counts. What an item says of its order is
    decided right after the order join and counted per product and user; the
    counts are then joined with the products and, per user, with the users. The
    orders of many items are joined in parts.
    """
    orders = with_copies(
        tables.orders,
        F.col("order_id").alias("parent_id"),
        F.col("user_id").alias("parent_user"),
        F.col("status").alias("parent_status"),
    )
    products = with_copies(
        tables.products, F.col("id").alias("known_product"), "category"
    ).withColumnRenamed("copies", "product_rows")
    users = with_copies(tables.users, F.col("id").alias("known_user"))

    items = tables.order_items.select("order_id", "product_id", "user_id", "status")
    joined = join_parents(items, orders, "order_id", "parent_id", "left")
    rows = F.coalesce("copies", F.lit(1))
    has_order = F.col("parent_id").isNotNull()
    flags = {
        "order_item_rows": F.lit(True),
        "items_without_order": ~has_order,
        "item_order_user_mismatches": has_order & (F.col("user_id") != F.col("parent_user")),
        "item_order_status_mismatches": has_order & (F.col("status") != F.col("parent_status")),
    }
    counted = joined.groupBy("product_id", "user_id").agg(
        *[sum_if(condition, rows).alias(name) for name, condition in flags.items()]
    )
    known = counted.join(
        products, counted["product_id"] == products["known_product"], "left"
    ).withColumn("product_rows", F.coalesce("product_rows", F.lit(1)))
    unknown = F.col("known_product").isNull()
    per_user = known.groupBy("user_id").agg(
        *[F.sum(F.col(name) * F.col("product_rows")).alias(name) for name in flags],
        sum_if(unknown, F.col("order_item_rows")).alias("items_without_product"),
    )
    checked = per_user.join(users, per_user["user_id"] == users["known_user"], "left")
    user_rows = F.coalesce("copies", F.lit(1))
    names = (
        "order_item_rows",
        "items_without_order",
        "items_without_product",
        "item_order_user_mismatches",
        "item_order_status_mismatches",
    )
    totals = {name: F.coalesce(F.sum(F.col(name) * user_rows), F.lit(0)) for name in names}
    totals["items_without_user"] = sum_if(
        F.col("known_user").isNull(), F.col("order_item_rows")
    )
    return checked.agg(*[total.alias(name) for name, total in totals.items()])


def item_count_reconciliation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Declared item counts against item rows; orders without items drop out."""
    counted = items.groupBy("order_id").agg(F.count("*").alias("actual"))
    joined = orders.select("order_id", "num_of_item").join(counted, "order_id")
    declared, actual = F.col("num_of_item"), F.col("actual")
    return joined.agg(
        F.count("*").alias("joined_orders"),
        count_if(declared == actual).alias("matching_item_counts"),
        count_if(declared != actual).alias("mismatching_item_counts"),
        F.max(F.abs(declared - actual)).alias("largest_item_count_difference"),
    )


# --- event dates ----------------------------------------------------------


def lifecycle_quality(items: DataFrame) -> DataFrame:
    """Missing and reversed lifecycle timestamps per item status."""
    return (
        items.groupBy("status")
        .agg(
            F.count("*").alias("order_items"),
            *[count_if(F.col(f"{e}_at").isNull()).alias(f"missing_{e}_at") for e in EVENTS],
            *_reversed_events(),
        )
        .orderBy(F.desc("order_items"))
    )


def event_date_coverage(items: DataFrame, as_of: date) -> DataFrame:
    bounds = [
        bound(F.to_date(f"{e}_at")).alias(f"{label}_{e}_date")
        for e in EVENTS
        for label, bound in (("first", F.min), ("latest", F.max))
    ]
    return items.agg(*bounds).withColumn("current_month_start", F.lit(month_start(as_of)))


def future_and_current_counts(items: DataFrame, as_of: date) -> DataFrame:
    """Items with events after ``as_of``, and in the as-of month or later."""
    return items.agg(
        F.count("*").alias("order_item_rows"),
        *[count_if(after_day(f"{e}_at", as_of)).alias(f"future_{e}_items") for e in EVENTS],
        *[
            count_if(in_open_month(f"{e}_at", as_of)).alias(f"current_month_{e}_items")
            for e in EVENTS
        ],
    )


def delivery_month_continuity(items: DataFrame, as_of: date) -> DataFrame:
    """All months between the first and last delivery, missing months first."""
    filled = fill_months(recognized_by_month(items, as_of), "revenue_month")
    return filled.select(
        F.col("revenue_month").alias("month"),
        F.coalesce("completed_orders", F.lit(0)).alias("completed_orders"),
        F.coalesce("completed_items", F.lit(0)).alias("completed_items"),
        round2(F.coalesce("recognized_revenue", F.lit(0))).alias("recognized_revenue"),
        (~F.col("observed")).alias("is_missing_delivery_month"),
    ).orderBy(F.desc("is_missing_delivery_month"), "month")


# --- prices ---------------------------------------------------------------


def price_sketches(items: DataFrame) -> DataFrame:
    """Sketches of the sale prices per month of creation, to be stored and merged."""
    return monthly_sketches(items, "created_at", "sale_price")


def yearly_price_points(items: DataFrame) -> DataFrame:
    """Price percentiles per year of creation: exact, and whether the sketches' are close.

    ``sketch_within_bound`` tells whether the rank of every percentile that the
    merged monthly sketches give is within the stated error of the exact rank.
    """
    percents = {"price_p01": 1, "price_median": 50, "price_p99": 99}
    priced = items.filter(F.col("sale_price").isNotNull() & F.col("created_at").isNotNull())
    year = F.year("created_at").alias("year")
    cells = (
        priced.groupBy(year, "sale_price")
        .agg(F.count("*").alias("items"))
        .withColumn("bucket", magnitude("sale_price"))
    )
    exact = quantiles(cells, "sale_price", "items", ["year"], "bucket", percents)
    by_year = merged(price_sketches(priced), (F.year("month").alias("year"),))
    close = points(by_year, {f"sketch_{name}": p for name, p in percents.items()})
    # A few rows a year.
    met = cells.select("year", "sale_price", "items").join(close, "year")
    price = F.col("sale_price").cast("double")

    def inside(name: str, percent: int) -> Column:
        below = F.sum(F.when(price < F.col(f"sketch_{name}"), F.col("items")).otherwise(0))
        upto = F.sum(F.when(price <= F.col(f"sketch_{name}"), F.col("items")).otherwise(0))
        total, wanted = F.sum("items"), percent / 100
        # The wanted rank lies in the ranks that rows of this price have, or close to them.
        return (below / total <= wanted + RANK_ERROR) & (upto / total >= wanted - RANK_ERROR)

    bounds = [inside(name, percent) for name, percent in percents.items()]
    checked = met.groupBy("year").agg(
        F.sum("items").alias("priced_items"),
        reduce(lambda a, b: a & b, bounds).alias("sketch_within_bound"),
    )
    return checked.join(exact, "year").select(
        "year",
        "priced_items",
        *[round2(F.col(name)).alias(name) for name in percents],
        "sketch_within_bound",
    )


def _sold_prices(items: DataFrame) -> DataFrame:
    """Items of each product and price. A product has no more rows than prices."""
    return items.groupBy("product_id", "sale_price").agg(F.count("*").alias("items"))


def price_cost_quality(items: DataFrame, products: DataFrame) -> DataFrame:
    """Missing, negative and loss-making prices over an item-product left join.

    Items are counted per product and price before the join.
    """
    costs = with_copies(products, F.col("id").alias("known_product"), "cost")
    sold = _sold_prices(items).withColumn("amount", money(items, "sale_price"))
    joined = join_parents(sold, costs, "product_id", "known_product", "left")
    joined = joined.withColumn("rows", F.coalesce("copies", F.lit(1)) * F.col("items"))
    rows, price, cost = F.col("rows"), F.col("sale_price"), F.col("cost")
    total = F.sum(times(joined, "amount", rows))
    return joined.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("order_item_rows"),
        sum_if(price.isNull(), rows).alias("missing_sale_price"),
        sum_if(price < 0, rows).alias("negative_sale_price"),
        sum_if(cost.isNull(), rows).alias("missing_product_cost"),
        sum_if(cost < 0, rows).alias("negative_product_cost"),
        sum_if(price < cost, rows).alias("items_sold_below_cost"),
        round2(F.min("amount")).alias("minimum_sale_price"),
        round2(F.max("amount")).alias("maximum_sale_price"),
        ratio2(total, F.sum(F.when(price.isNotNull(), rows))).alias("average_sale_price"),
    )


def price_distribution(items: DataFrame, products: DataFrame) -> DataFrame:
    """Price thresholds and exact percentiles over an item-product inner join.

    Items are counted per product and price before the join and per price after
    it; percentiles are located among buckets that follow the prices and then
    inside one bucket.
    """
    retail = with_copies(products, F.col("id").alias("known_product"), "retail_price")
    joined = join_parents(_sold_prices(items), retail, "product_id", "known_product")
    price, rows = F.col("sale_price"), F.col("rows")
    differs = F.abs(price - F.col("retail_price")) > F.lit("0.01").cast(
        joined.schema["sale_price"].dataType
    )
    # Only keys and one count: the ranking reads the cells twice, and with equal
    # columns both readers share one shuffle.
    cells = (
        joined.groupBy("sale_price", differs.alias("differs"))
        .agg(F.sum(F.col("copies") * F.col("items")).alias("rows"))
        .withColumn("priced_rows", F.when(price.isNull(), 0).otherwise(rows))
        .withColumn("bucket", magnitude("sale_price"))
    )
    counts = cells.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("order_item_rows"),
        sum_if(price < 1, rows).alias("items_below_one_dollar"),
        sum_if(price < 5, rows).alias("items_below_five_dollars"),
        sum_if(price > 500, rows).alias("items_above_five_hundred_dollars"),
        sum_if(F.col("differs"), rows).alias("sale_retail_price_differences"),
    )
    percents = {"sale_price_p01": 1, "sale_price_median": 50, "sale_price_p99": 99}
    points = quantiles(cells, "sale_price", "priced_rows", [], "bucket", percents)
    return one_row(counts, points.select(*[round2(F.col(c)).alias(c) for c in percents]))


# --- foundations of the views ---------------------------------------------


def retention_foundation(items: DataFrame, as_of: date) -> DataFrame:
    """Customer-month grain behind the cohorts; items without user count once."""
    months = (
        recognized_items(items, as_of)
        .groupBy("user_id")
        .agg(
            F.min(month_of("delivered_at")).alias("cohort_month"),
            F.countDistinct(month_of("delivered_at")).alias("active_months"),
        )
    )
    return months.agg(
        F.count("*").alias("customer_rows"),
        F.count("user_id").alias("unique_buyers"),
        count_if(F.col("user_id").isNull()).alias("missing_user_ids"),
        F.sum("active_months").alias("customer_month_rows"),
        count_if(F.col("active_months") > 1).alias("customers_active_in_multiple_months"),
        F.min("cohort_month").alias("first_cohort_month"),
        F.max("cohort_month").alias("latest_cohort_month"),
    )


def product_foundation(items: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Recognized items against product attributes, and the source totals.

    Items are collapsed per product before the join.
    """
    attributes = with_copies(
        products,
        F.col("id").alias("known_product"),
        "category",
        "name",
        money(products, "cost").alias("cost"),
    )
    sold = recognized_items(items, as_of).withColumn("price", money(items, "sale_price"))
    price, cost = F.col("price"), F.col("cost")
    sales = sold.groupBy("product_id").agg(
        F.count("*").alias("rows"),
        F.count(price).alias("priced_rows"),
        count_if(price < 0).alias("negative_rows"),
        F.sum(price).alias("revenue"),
    )
    joined = sales.join(
        attributes, F.col("product_id") == F.col("known_product"), "left"
    ).withColumn("copies", F.coalesce("copies", F.lit(1)))
    joined = joined.withColumn(
        "profit", F.col("revenue") - times(joined, "cost", F.col("priced_rows"))
    )
    copies = F.col("copies")
    rows = F.col("rows") * copies

    def blank(name: str) -> Column:
        return F.col(name).isNull() | (F.trim(name) == "")

    checked = joined.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("completed_item_rows"),
        sum_if(F.col("known_product").isNull(), rows).alias("unmatched_product_rows"),
        sum_if(blank("category"), rows).alias("missing_category_rows"),
        sum_if(blank("name"), rows).alias("missing_product_name_rows"),
        sum_if(cost.isNull(), rows).alias("missing_product_cost_rows"),
        sum_if(cost < 0, rows).alias("negative_product_cost_rows"),
        F.coalesce(
            F.sum((F.col("rows") - F.col("priced_rows")) * copies), F.lit(0)
        ).alias("missing_sale_price_rows"),
        F.coalesce(F.sum(F.col("negative_rows") * copies), F.lit(0)).alias(
            "negative_sale_price_rows"
        ),
        F.countDistinct("category").alias("categories"),
        F.countDistinct("product_id").alias("products_sold"),
        round2(F.sum(times(joined, "revenue", copies))).alias("source_recognized_revenue"),
        round2(F.sum(times(joined, "profit", copies))).alias("source_estimated_gross_profit"),
    )
    first, *others = checked.columns
    return one_row(checked, _distinct(sold, "id", "unique_completed_item_ids")).select(
        first, "unique_completed_item_ids", *others
    )


def order_operations_foundation(orders: DataFrame, as_of: date) -> DataFrame:
    """Checks over all orders and over eligible orders, in one scan."""
    eligible = F.coalesce(in_complete_month("created_at", as_of), F.lit(False))
    status = F.col("status")

    def among(condition: Column) -> Column:
        return count_if(eligible & condition)

    created = F.when(eligible, F.to_date("created_at"))
    counted = orders.agg(
        F.count("*").alias("all_order_rows"),
        count_if(F.col("created_at").isNull()).alias("missing_created_at"),
        count_if(in_open_month("created_at", as_of)).alias("current_or_future_created_orders"),
        count_if(after_day("created_at", as_of)).alias("future_created_orders"),
        count_if(eligible).alias("eligible_orders"),
        F.countDistinct(F.when(eligible, F.col("order_id"))).alias("unique_order_ids"),
        F.min(created).alias("first_created_date"),
        F.max(created).alias("latest_created_date"),
        *[among(status == s).alias(f"{s.lower()}_orders") for s in STATUSES],
        among(status.isNull()).alias("missing_status"),
        among(~status.isin(*STATUSES)).alias("unexpected_status"),
        among((status == "Complete") & F.col("delivered_at").isNull()).alias(
            "complete_without_delivery"
        ),
        among((status == "Returned") & F.col("returned_at").isNull()).alias(
            "returned_without_return_date"
        ),
        *[
            among(_precedes(later, earlier)).alias(f"{later}_before_{earlier}")
            for earlier, later in zip(EVENTS, EVENTS[1:])
        ],
        *[among(after_day(f"{e}_at", as_of)).alias(f"future_{e}_orders") for e in EVENTS[1:]],
    )
    known = sum((F.col(f"{s.lower()}_orders") for s in STATUSES), F.lit(0))
    return counted.select(
        "*",
        (F.col("eligible_orders") == F.col("unique_order_ids")).alias("one_row_per_order"),
        (F.col("eligible_orders") == known).alias("known_statuses_cover_all_orders"),
        *[
            pct(F.col(f"{s}_orders"), F.col("eligible_orders"))
            .cast("double")
            .alias(f"current_{s}_share_pct")
            for s in ("cancelled", "returned", "complete")
        ],
    )


def order_duration_foundation(
    orders: DataFrame, as_of: date, exact: bool = True
) -> DataFrame:
    """Duration quality over the whole history, one row per duration type.

    ``exact=False`` estimates the quantiles from a sketch.
    """
    durations = classified_durations(orders, as_of)
    outcome, seconds = F.col("outcome"), F.col("elapsed_seconds")
    end_date = F.when(outcome == VALID, F.to_date("end_at"))
    outcomes = {
        "missing_end_orders": MISSING_END,
        "incomplete_or_future_end_month_orders": OPEN_END,
        "missing_start_orders": MISSING_START,
        "reversed_timestamp_orders": REVERSED,
        "valid_duration_orders": VALID,
    }
    counts = durations.groupBy("duration_type").agg(
        F.count("*").alias("candidate_orders"),
        F.countDistinct("order_id").alias("unique_candidate_order_ids"),
        *[count_if(outcome == value).alias(name) for name, value in outcomes.items()],
        count_if(seconds == 0).alias("zero_duration_orders"),
        F.min(end_date).alias("first_valid_end_date"),
        F.max(end_date).alias("latest_valid_end_date"),
        F.min(seconds).alias("shortest"),
        F.sum(seconds).alias("seconds"),
        F.max(seconds).alias("longest"),
    )
    if exact:
        cells = (
            durations.groupBy("duration_type", "elapsed_seconds")
            .agg(F.count("elapsed_seconds").alias("valid"))
            .withColumn("hour", F.floor(seconds / 3600))
        )
        middle = quantiles(
            cells, "elapsed_seconds", "valid", ["duration_type"], "hour", MIDDLE
        )
    else:
        middle = durations.groupBy("duration_type").agg(
            *approximate_quantiles("elapsed_seconds", MIDDLE)
        )

    def days(value: Column) -> Column:
        return round2(value / SECONDS_PER_DAY).cast("double")

    accounted = sum((F.col(name) for name in outcomes), F.lit(0))
    return (
        counts.join(middle, "duration_type", "left")
        .select(
            "duration_type",
            "candidate_orders",
            "unique_candidate_order_ids",
            *outcomes,
            "zero_duration_orders",
            "first_valid_end_date",
            "latest_valid_end_date",
            days(F.col("shortest")).alias("minimum_days"),
            days(ratio(F.col("seconds"), F.col("valid_duration_orders"))).alias("average_days"),
            days(F.col("median")).alias("approximate_median_days"),
            days(F.col("p90")).alias("approximate_p90_days"),
            days(F.col("longest")).alias("maximum_days"),
            (F.col("candidate_orders") == F.col("unique_candidate_order_ids")).alias(
                "one_row_per_candidate_order"
            ),
            (F.col("candidate_orders") == accounted).alias("all_candidates_accounted_for"),
        )
        .orderBy("duration_type")
    )
