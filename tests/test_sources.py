"""Reading the source, publishing the views, and the shared folder."""

import pytest

from orderlens import load_files, load_tables
from orderlens.plans import audits, publish, views
from orderlens.session import materialize, shared_folder
from orderlens.sources.mapping import TEST_AS_OF, map_test_tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return map_test_tables(spark, SMALL)


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
def test_files(spark, tables, tmp_path, file_format):
    for name, df in tables.named().items():
        df.write.format(file_format).save(f"{tmp_path}/{name}.{file_format}")
    loaded = load_files(spark, str(tmp_path), file_format)
    expected = audits.key_uniqueness(tables).collect()
    assert audits.key_uniqueness(loaded).collect() == expected


def test_catalog(spark, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS retail")
    try:
        for name, df in tables.named().items():
            df.write.saveAsTable(f"retail.{name}", mode="overwrite")
        loaded = load_tables(spark, "retail")
        assert loaded.orders.count() == tables.orders.count()
    finally:
        spark.sql("DROP DATABASE retail CASCADE")


def test_schema_profile(tables):
    rows = audits.schema_profile(tables).collect()
    assert [r["column_name"] for r in rows if r["table_name"] == "users"] == ["id"]
    orders = [r for r in rows if r["table_name"] == "orders"]
    assert [r["ordinal_position"] for r in orders] == list(range(1, 9))
    assert orders[0]["data_type"] == "bigint"
    assert [r["table_name"] for r in rows] == sorted(r["table_name"] for r in rows)


def test_views_in_the_catalog_and_in_a_folder(spark, tables, tmp_path):
    built = {
        "monthly_revenue": views.monthly_revenue(tables.order_items, TEST_AS_OF),
        "monthly_order_status": views.monthly_order_status(tables.orders, TEST_AS_OF),
    }
    publish.register_views(built)
    total = spark.sql("SELECT sum(completed_items) AS n FROM monthly_revenue").first()["n"]
    assert total == 1154
    publish.write_views(built, str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/monthly_order_status.parquet")
    assert stored.count() == built["monthly_order_status"].count()


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    stored = materialize(spark.range(5), "five")
    assert stored.count() == 5
    assert all(folder in f for f in stored.inputFiles())


class Cluster:
    """A session without the setting, away from local mode."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())


def test_shuffles_follow_the_input_size(spark, settings, tables, monkeypatch):
    from orderlens import session

    key = session.INITIAL_PARTITIONS
    assert 0 < session.input_bytes(tables.products) < 100_000
    session.size_shuffles(spark, tables.orders)
    assert spark.conf.get(key, None) is None
    monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
    session.size_shuffles(spark, tables.products)
    assert int(spark.conf.get(key)) == -(-session.input_bytes(tables.products) // 1000)
    monkeypatch.setattr(session, "PARTITION_BYTES", 1)
    session.size_shuffles(spark, tables.products)
    assert int(spark.conf.get(key)) == session.input_bytes(tables.products)
    assert session.partitions_for(100 << 40, 128 << 20) == 819_200
    monkeypatch.setattr(session, "PARTITION_BYTES", 1 << 30)
    session.size_shuffles(spark, tables.products)
    assert spark.conf.get(key, None) is None
    settings(**{key.replace(".", "__"): "7"})
    monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
    session.size_shuffles(spark, tables.products)
    assert spark.conf.get(key) == "7"


def test_stored_tables_are_released(spark):
    from pathlib import Path

    from orderlens import session

    materialize(spark.range(3), "kept-a-moment")
    folder = Path(session._stored(spark).removeprefix("file:"))
    assert any(folder.iterdir())
    session.release(spark)
    assert not folder.exists()


def stored_folders(spark):
    from pathlib import Path

    from orderlens import session

    folder = Path(session._stored(spark).removeprefix("file:"))
    return {p.name.rsplit("-", 1)[0] for p in folder.iterdir()} if folder.exists() else set()


def test_a_scope_removes_what_was_stored_in_it(spark):
    from orderlens import session

    session.release(spark)
    kept = materialize(spark.range(2), "outside")
    with session.scope(spark):
        outer = materialize(spark.range(3), "outer")
        with session.scope(spark):
            inner = materialize(spark.range(4), "inner")
            assert inner.count() == 4
        assert stored_folders(spark) == {"outside", "outer"}
        with pytest.raises(ZeroDivisionError):
            with session.scope(spark):
                materialize(spark.range(5), "broken")
                spark.range(1).write.parquet(session.scratch(spark, "folder"))
                1 / 0
        assert stored_folders(spark) == {"outside", "outer"}
        assert outer.count() == 3
    assert stored_folders(spark) == {"outside"} and kept.count() == 2
    session.discard(kept)
    assert stored_folders(spark) == set()


def test_discard_leaves_other_tables_alone(spark, tmp_path):
    from orderlens import session

    spark.range(3).write.parquet(f"{tmp_path}/own")
    session.discard(spark.read.parquet(f"{tmp_path}/own"))
    assert spark.read.parquet(f"{tmp_path}/own").count() == 3


class Local(Cluster):
    """A local session without the setting."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.sql.warehouse.dir": "file:/warehouse"}.get(key, default)

    class sparkContext(Cluster.sparkContext):
        master = "local[3]"


def test_a_local_session_stores_in_its_warehouse():
    assert shared_folder(Local()) == "file:/warehouse"


@pytest.mark.parametrize(
    "name", ["validate_all", "validate_deployed", "snapshot_drift", "drift_location",
             "refreshed_revenue", "product_reconcile"]
)
def test_nothing_is_left_after_a_query_and_its_release(spark, name):
    import __spark_entry__ as registry
    from orderlens import session

    session.release(spark)
    with session.scope(spark):
        registry.queries()[name](spark, SMALL).collect()
        assert stored_folders(spark)
    assert stored_folders(spark) == set()


def test_views_follow_their_source(spark, tmp_path):
    """Building views runs no job, and a view sees rows that are added later."""
    from orderlens.plans import views
    from orderlens.sources import load_files
    from orderlens.sources.mapping import TEST_AS_OF, map_test_tables

    small = map_test_tables(spark, "/root/testdata/sf0.001")
    for name in ("orders", "order_items", "products", "users"):
        getattr(small, name).write.parquet(f"{tmp_path}/{name}.parquet")
    tables = load_files(spark, str(tmp_path))
    spark.sparkContext.setJobGroup("build", "views")
    views.build_views(tables, TEST_AS_OF)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("rest", "rest")
    publish.register_views(
        {"performance": views.product_performance(tables.order_items, tables.products, TEST_AS_OF)}
    )
    try:
        items = "SELECT sum(completed_items) AS n FROM performance"
        before = spark.sql(items).first()["n"]
        small.order_items.write.mode("append").parquet(f"{tmp_path}/order_items.parquet")
        spark.catalog.refreshTable("performance")
        # The view that was registered before sees the rows.
        assert spark.sql(items).first()["n"] == 2 * before
    finally:
        spark.catalog.dropTempView("performance")
