"""Every registered query against DuckDB: generated tables and dirty tables."""

import duckdb
import pytest
from compare import connect, difference
from dirty import make

import __spark_entry__ as registry
from oracle import statements as oracle
from orderlens import RetailTables, load_files

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def generated():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_generated_tables(spark, generated, name):
    df = registry.queries()[name](spark, SMALL)
    assert difference(df, generated, registry.oracle_sql()[name]) is None


def test_every_query_has_a_statement():
    assert set(NAMES) <= set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


# --- the same statements over retail tables with irregular rows

TABLES = {"ord": "orders", "itm": "order_items", "prd": "products", "usr": "users"}


@pytest.fixture(scope="module", params=[11, 12])
def dirty(request, tmp_path_factory):
    folder = make(tmp_path_factory.mktemp("dirty"), request.param)
    con = duckdb.connect()
    for table in TABLES.values():
        con.execute(f"CREATE TABLE r_{table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", NAMES)
def test_dirty_tables(spark, dirty, name, monkeypatch):
    folder, con = dirty
    for part, table in TABLES.items():
        monkeypatch.setitem(oracle.PARTS, part, f"SELECT * FROM r_{table}")
        monkeypatch.setitem(oracle.READS, part, [])
    df = registry._plain(registry.QUERIES[name](registry.Session(load_files(spark, folder))))
    assert difference(df, con, oracle.statements()[name]) is None


FLOAT_COLUMNS = {"order_items": ["sale_price"], "products": ["cost", "retail_price"]}
FLOAT_NAMES = [
    "category_performance",
    "customer_segments",
    "monthly_revenue_growth",
    "price_cost_quality",
    "product_foundation",
    "product_performance",
    "product_view_reconcile",
]


@pytest.mark.parametrize("name", FLOAT_NAMES)
def test_floating_prices_give_the_same_results(spark, dirty, name):
    exact = load_files(spark, dirty[0])
    floating = {
        table: df.withColumns(
            {c: df[c].cast("double") for c in FLOAT_COLUMNS.get(table, [])}
        )
        for table, df in exact.named().items()
    }
    build = registry.QUERIES[name]
    expected = registry._plain(build(registry.Session(exact)))
    found = registry._plain(build(registry.Session(RetailTables(**floating))))
    assert found.schema.names == expected.schema.names
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
