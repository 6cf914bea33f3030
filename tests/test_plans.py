"""Properties of the executed plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from orderlens.operators import hotkeys
from orderlens.plans import audits, views
from orderlens.sources import RetailTables
from orderlens.sources.mapping import TEST_AS_OF, map_test_tables

SMALL = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("\n+- == Initial Plan ==")[0]


@pytest.fixture(scope="module")
def tables(spark):
    return map_test_tables(spark, SMALL)


# Their results are read from stored tables; the plans that wrote them are not seen.
STORED = {"validate_all", "validate_deployed", "snapshot_drift", "drift_location"} | {
    name for name in registry.QUERIES if name.startswith("refreshed_")
}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - STORED))
def test_no_pair_joins_and_no_python(spark, settings, name):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = executed(registry.queries()[name](spark, SMALL))
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas"):
        assert node not in plan


@pytest.mark.parametrize(
    "name",
    ["monthly_order_durations", "order_duration_foundation", "price_distribution",
     "growth_vs_monthly", "rolling_window_check"],
)
def test_shared_stages_run_once(spark, name):
    assert "ReusedExchange" in executed(registry.queries()[name](spark, SMALL))


@pytest.mark.parametrize("name", ["orders_overview", "order_items_profile", "monthly_revenue"])
def test_distinct_counts_do_not_multiply_rows(spark, name):
    assert "Expand" not in executed(registry.queries()[name](spark, SMALL))


def test_filters_and_columns_reach_the_scan(spark, tables, tmp_path):
    tables.order_items.write.parquet(f"{tmp_path}/items")
    stored = spark.read.parquet(f"{tmp_path}/items")
    df = views.monthly_revenue(stored, TEST_AS_OF)
    df.collect()
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(status,Complete)" in plan
    assert "LessThan(delivered_at,2001-07-01T00:00" in plan
    read = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",") if ":" in c} == {
        "order_id", "status", "delivered_at", "sale_price"
    }


def test_unused_item_counts_are_not_computed(tables):
    plan = executed(tables.orders.groupBy("status").count())
    assert "l_orderkey" not in plan


def test_products_are_not_sorted_in_one_task(tables):
    ranked = views.product_performance(tables.order_items, tables.products, TEST_AS_OF)
    plan = executed(ranked)
    # What is left in one task are bucket and grand totals, never products.
    for window in re.findall(r"Window \[.*", plan):
        assert "rank(" not in window
        assert "recognized_revenue" not in window or "bucket" in window
    # No row carries the borders of all buckets.
    assert "percentile" not in plan


def skewed_items(spark, rows=60_000):
    """A third of the items belong to one order, another third to one product, and so on."""

    def key(n, third):
        spread = F.pmod(F.xxhash64("id", F.lit(n)), F.lit(n))
        return F.when(F.col("id") % 3 == third, 0).otherwise(spread)

    stamp = F.lit("1999-05-05 10:00:00").cast("timestamp_ntz")
    return spark.range(0, rows, 1, 6).select(
        F.col("id").cast("string").alias("id"),
        key(9_001, 0).alias("order_id"),
        key(3_001, 1).alias("product_id"),
        key(2_003, 2).alias("user_id"),
        F.lit("Complete").alias("status"),
        *[stamp.alias(f"{e}_at") for e in ("created", "shipped", "delivered", "returned")],
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 100)
        .cast("decimal(18,2)")
        .alias("sale_price"),
    )


@pytest.fixture
def skewed(spark, settings, tmp_path):
    # Thresholds scaled down to the test size.
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    skewed_items(spark).write.parquet(f"{tmp_path}/items")
    items = spark.read.parquet(f"{tmp_path}/items")
    orders = items.groupBy("order_id").agg(
        F.first("user_id").alias("user_id"),
        F.first("status").alias("status"),
        *[F.first(f"{e}_at").alias(f"{e}_at") for e in audits.EVENTS],
        F.count("*").alias("num_of_item"),
    )
    orders.write.parquet(f"{tmp_path}/orders")
    price = F.lit("1.00").cast("decimal(18,2)")
    spark.range(3_001).select(
        "id",
        F.concat(F.lit("p"), "id").alias("name"),
        (F.col("id") % 5).cast("string").alias("category"),
        price.alias("cost"),
        price.alias("retail_price"),
    ).write.parquet(f"{tmp_path}/products")
    return RetailTables(
        orders=spark.read.parquet(f"{tmp_path}/orders"),
        order_items=items,
        products=spark.read.parquet(f"{tmp_path}/products"),
        users=spark.range(2_003),
    )


@pytest.fixture
def no_skew_rule(settings):
    """Hot keys are dealt by the plan itself."""
    settings(spark__sql__adaptive__skewJoin__enabled="false")


def test_hot_product_is_split_in_the_category_join(skewed, no_skew_rule):
    df = views.category_performance(skewed.order_items, skewed.products, TEST_AS_OF)
    assert "__part" in executed(df)
    assert sum(r["completed_items"] for r in df.collect()) == 60_000


def test_hot_order_is_split_in_the_relation_audit(skewed, no_skew_rule):
    df = audits.referential_integrity(skewed)
    assert "__part" in executed(df)
    row = df.first()
    assert row["order_item_rows"] == 60_000
    assert row["items_without_order"] == row["items_without_product"] == 0
    assert row["items_without_user"] == 0


def test_hot_product_is_split_in_the_price_audits(skewed, no_skew_rule):
    for audit in (audits.price_cost_quality, audits.price_distribution):
        df = audit(skewed.order_items, skewed.products)
        assert "__part" in executed(df)
        assert df.first()["order_item_rows"] == 60_000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_in_parts(spark, settings, how):
    """Equal to a plain join: hot keys, NULL keys, repeated and missing parents."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    keys = [7] * 500 + [None] * 300 + [8] * 200 + list(range(100)) + [999]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, n long")
    parents = spark.createDataFrame(
        [(i, f"p{i}") for i in [7, 7, *range(5, 90), None, 2000]], "id long, name string"
    )
    plain = rows.join(parents, F.col("k") == F.col("id"), how)
    dealt = hotkeys.join_parents(rows, parents, "k", "id", how, share=50)
    assert dealt.columns == plain.columns
    assert sorted(dealt.collect(), key=repr) == sorted(plain.collect(), key=repr)
    hot = {r["hot_key"]: r["parts"] for r in hotkeys.frequent(rows, "k", 50).collect()}
    assert set(hot) == {7, 8, None} and hot[7] > hot[None] > hot[8] > 1


@pytest.mark.parametrize(("limit", "small"), [("-1", False), ("-1b", False), ("0", False), ("10MB", True)])
def test_broadcast_limits(spark, settings, tmp_path, limit, small):
    """Also the negative limit that turns broadcasting off."""
    spark.range(5).write.parquet(f"{tmp_path}/five")
    settings(spark__sql__autoBroadcastJoinThreshold=limit)
    assert hotkeys._small(spark.read.parquet(f"{tmp_path}/five")) is small


def test_no_part_holds_a_hot_key(skewed):
    hot = hotkeys.frequent(skewed.order_items, "product_id", 50)
    assert {r["hot_key"]: r["parts"] for r in hot.collect()} == {0: 17}
    joined = hotkeys.join_parents(
        skewed.order_items, skewed.products.withColumnRenamed("id", "pid"), "product_id", "pid", share=50
    )
    assert joined.count() == 60_000


def test_collapsed_joins_have_no_hot_key(skewed):
    for df in (
        audits.product_join_coverage(skewed.order_items, skewed.products),
        audits.product_foundation(skewed.order_items, skewed.products, TEST_AS_OF),
        views.customer_segments(skewed.order_items, skewed.users, TEST_AS_OF),
    ):
        assert "skew=true" not in executed(df)


def test_a_revenue_shared_by_a_third_of_the_products_is_split(spark, skewed, tmp_path):
    rows = 60_000
    spread = (F.pmod(F.xxhash64("id"), F.lit(100_000_000)) / 100).cast("decimal(38,2)")
    spark.range(0, rows, 1, 6).select(
        "id",
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
        (F.col("id") % 3).cast("string").alias("category"),
        F.when(F.col("id") % 3 == 0, F.lit(5).cast("decimal(38,2)")).otherwise(spread).alias(
            "recognized_revenue"
        ),
    ).write.parquet(f"{tmp_path}/totals")
    totals = spark.read.parquet(f"{tmp_path}/totals")
    ranked = views._ranked(totals)
    assert "skew=true" in executed(ranked)
    shared = ranked.filter("recognized_revenue = 5 and category = '0'")
    assert shared.count() == rows / 3
    assert shared.select("category_revenue_rank").distinct().collect() == [(1,)]
    expected = 1 + totals.filter("recognized_revenue > 5").count()
    assert shared.select("overall_revenue_rank").distinct().collect() == [(expected,)]
