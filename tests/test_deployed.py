"""Views that are in use: opened with their declared columns and checked."""

import pytest
from pyspark.sql import functions as F

from orderlens import load_files
from orderlens.plans import publish, validation, views
from orderlens.sources import contract
from orderlens.sources.mapping import TEST_AS_OF as DAY
from orderlens.sources.mapping import map_test_tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return validation.pin_tables(map_test_tables(spark, SMALL), DAY)


@pytest.fixture
def folder(tables, tmp_path):
    publish.write_views(views.build_views(tables, DAY), str(tmp_path))
    return tmp_path


def failed(df):
    return {(r["check_name"], r["metric"]) for r in df.filter("NOT passed").collect()}


def test_written_views(spark, tables, folder):
    declared = publish.declared_schemas(tables, DAY)
    deployed = publish.written_views(spark, str(folder), declared)
    assert {n: df.dtypes for n, df in deployed.items()} == {
        n: df.dtypes for n, df in views.build_views(tables, DAY).items()
    }
    result = validation.validate_deployed(tables, deployed, DAY)
    assert failed(result) == set()
    assert sorted(result.collect()) == sorted(validation.validate_all(tables, DAY).collect())


def test_damage_to_a_deployed_view_is_found(spark, tables, folder):
    """The stored rows are checked, not views built anew."""
    path = f"{folder}/monthly_order_status.parquet"
    rows = spark.read.parquet(path).withColumn("complete_orders", F.col("complete_orders") + 1)
    spark.createDataFrame(rows.collect(), rows.schema).write.mode("overwrite").parquet(path)
    deployed = publish.written_views(spark, str(folder), publish.declared_schemas(tables, DAY))
    found = failed(validation.validate_deployed(tables, deployed, DAY))
    assert ("order_status", "status_count_mismatches") in found
    assert {check for check, _ in found} == {"order_status"}


def test_damage_to_a_registered_view_is_found(spark, tables):
    built = views.build_views(tables, DAY)
    declared = publish.declared_schemas(tables, DAY)
    publish.register_views(built)
    try:
        deployed = publish.registered_views(spark, declared)
        assert failed(validation.validate_deployed(tables, deployed, DAY)) == set()
        missing = F.when(F.col("product_id") > 10, F.col("product_name"))
        publish.register_views(
            {"product_performance": built["product_performance"].withColumn("product_name", missing)}
        )
        deployed = publish.registered_views(spark, declared)
        assert failed(validation.validate_deployed(tables, deployed, DAY)) == {
            ("products", "missing_product_attributes")
        }
    finally:
        for name in built:
            spark.catalog.dropTempView(name)


def test_views_with_other_columns_are_refused(spark, tables, folder):
    declared = publish.declared_schemas(tables, DAY)
    path = f"{folder}/monthly_order_status.parquet"
    rows = spark.read.parquet(path).collect()
    spark.createDataFrame(rows).withColumn("complete_orders", F.lit("x")).drop(
        "created_orders"
    ).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(path)
    with pytest.raises(contract.SchemaDrift) as error:
        publish.written_views(spark, str(folder), declared)
    assert error.value.table == "monthly_order_status"
    assert {c for c, _, _ in error.value.drift} == {"complete_orders", "created_orders", "more"}
    assert "declared bigint, found string" in str(error.value)


def test_every_flag_and_count_of_a_check_is_declared(spark, tables):
    built = validation.pin_views(views.build_views(tables, DAY))
    for name, result in validation.run_checks(tables, built, DAY).items():
        rules = validation.CHECKS[name]
        assert set(rules.flags) == {c for c, t in result.dtypes if t == "boolean"}, name
        assert set(rules.zero) >= {c for c in result.columns if "mismatches" in c}, name


# --- the contract of the source


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("source")
    for name, df in map_test_tables(spark, SMALL).named().items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_readers_get_the_declared_columns(spark, source):
    """Drift is told by column; readers with the declared columns run no job."""
    drift = contract.stored_drift(spark, source).collect()
    assert ("order_items", "id", "bigint", "string") in map(tuple, drift)
    declared = {
        name: contract.with_types(
            {name: table},
            **{r["column_name"]: r["found"] for r in drift if r["table_name"] == name},
        )[name]
        for name, table in contract.RETAIL.items()
    }
    assert contract.stored_drift(spark, source, declared).count() == 0
    spark.sparkContext.setJobGroup("open", "open")
    tables = load_files(spark, source, contracts=declared)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("open")
    spark.sparkContext.setJobGroup("rest", "rest")
    plain = load_files(spark, source)
    for build in (
        lambda t: views.monthly_revenue(t.order_items, DAY),
        lambda t: views.monthly_order_status(t.orders, DAY),
    ):
        assert sorted(build(tables).collect()) == sorted(build(plain).collect())


def test_violations(spark):
    orders = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (None, None, None), (None, "b", None)],
        "order_id long, status string, created_at timestamp",
    )
    items = spark.createDataFrame(
        [(1, 1, "x"), (2, None, "x")], "id long, order_id long, status string"
    )
    products = spark.createDataFrame([(1,), (1,), (1,)], "id long")
    users = spark.createDataFrame([], "id long")
    tables = {"orders": orders, "order_items": items, "products": products, "users": users}
    found = {
        (r["table_name"], r["rule"], r["column_name"]): r["violating_rows"]
        for r in contract.violations(tables).collect()
    }
    assert found == {
        ("orders", "filled", "order_id"): 2,
        ("orders", "filled", "status"): 1,
        ("orders", "filled", "created_at"): 4,
        ("orders", "unique", "order_id"): 2,
        ("order_items", "filled", "id"): 0,
        ("order_items", "filled", "order_id"): 1,
        ("order_items", "filled", "status"): 0,
        ("order_items", "unique", "id"): 0,
        ("products", "filled", "id"): 0,
        ("products", "unique", "id"): 2,
        ("users", "filled", "id"): 0,
        ("users", "unique", "id"): 0,
    }
