"""Retail tables derived from the generated wholesale test tables."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.tables import TABLE_NAMES, RetailTables

# The test data ends in August 2001; this day leaves recent rows to exclude.
TEST_AS_OF = date(2001, 7, 15)


def _later(start: str, seconds: Column) -> Column:
    return F.col(start) + F.make_dt_interval(secs=seconds)


def _orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    status = (
        F.when(F.col("o_orderstatus") == "P", "Processing")
        .when(F.col("o_orderstatus") == "O", "Shipped")
        .when(priority.isin("1", "2", "3"), "Complete")
        .when(priority == "4", "Cancelled")
        .otherwise("Returned")
    )
    staged = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )
    # Seconds from each event to the next.
    key, reached = F.col("order_id"), F.col("status")
    packing, travel, stay = key * 7919 % 259201, key * 104729 % 432001, key * 1299709 % 259201
    line_counts = lines.groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return staged.join(line_counts, key == F.col("l_orderkey"), "left").select(
        "order_id",
        "user_id",
        "status",
        "created_at",
        F.when(
            reached.isin("Shipped", "Complete", "Returned"), _later("created_at", packing)
        ).alias("shipped_at"),
        F.when(
            reached.isin("Complete", "Returned"), _later("created_at", packing + travel)
        ).alias("delivered_at"),
        F.when(reached == "Returned", _later("created_at", packing + travel + stay)).alias(
            "returned_at"
        ),
        F.coalesce("lines", F.lit(0)).alias("num_of_item"),
    )


def _items(lines: DataFrame, orders: DataFrame) -> DataFrame:
    parent = orders.drop("num_of_item")
    delay = (F.col("l_partkey") * 37 + F.col("l_linenumber").cast("bigint") * 40009) % 345601
    return lines.join(parent, lines["l_orderkey"] == parent["order_id"]).select(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.to_date("l_shipdate").cast("string"),
        ).alias("id"),
        "order_id",
        "user_id",
        F.col("l_partkey").alias("product_id"),
        "status",
        _later("created_at", delay).alias("created_at"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("sale_price"),
    )


class MappedTables:
    """The retail tables of a folder of wholesale test tables, each read when first used."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        return self._read("lineitem")

    @cached_property
    def orders(self) -> DataFrame:
        return _orders(self._read("orders"), self._lines)

    @cached_property
    def order_items(self) -> DataFrame:
        return _items(self._lines, self.orders)

    @cached_property
    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(18,2)")
        return self._read("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            (price * F.lit("0.6").cast("decimal(1,1)")).alias("cost"),
            price.alias("retail_price"),
        )

    @cached_property
    def users(self) -> DataFrame:
        return self._read("customer").select(F.col("c_custkey").alias("id"))


def map_test_tables(spark: SparkSession, folder: str) -> RetailTables:
    """All four retail tables of a folder of wholesale test tables."""
    mapped = MappedTables(spark, folder)
    return RetailTables(**{name: getattr(mapped, name) for name in TABLE_NAMES})
