"""The four input tables and how to read them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources.contract import TableContract


@dataclass(frozen=True)
class RetailTables:
    """Orders, their items, the products sold and the registered customers.

    ``orders``: order_id, user_id, status, created_at, shipped_at,
    delivered_at, returned_at, num_of_item. ``order_items``: id, order_id,
    user_id, product_id, status, the four event times, sale_price.
    ``products``: id, name, category, cost, retail_price. ``users``: id.
    """

    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    users: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


TABLE_NAMES = tuple(f.name for f in fields(RetailTables))


def load_files(
    spark: SparkSession,
    folder: str,
    file_format: str = "parquet",
    contracts: dict[str, TableContract] | None = None,
) -> RetailTables:
    """Read ``folder/<table>.<format>`` for each of the four tables.

    With contracts the readers get the declared columns and no file is opened
    before a report runs; ``contract.stored_drift`` tells whether the files agree.
    """

    def read(name: str) -> DataFrame:
        reader = spark.read.format(file_format)
        if contracts:
            reader = reader.schema(contracts[name].schema)
        return reader.load(f"{folder}/{name}.{file_format}")

    return RetailTables(**{name: read(name) for name in TABLE_NAMES})


def load_tables(spark: SparkSession, database: str) -> RetailTables:
    """Use the four tables of a catalog database."""
    return RetailTables(**{name: spark.table(f"{database}.{name}") for name in TABLE_NAMES})
