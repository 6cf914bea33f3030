"""Where finished views go and are read back from: the session catalog or a folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from orderlens.plans.views import build_views
from orderlens.sources import RetailTables
from orderlens.sources.contract import check_schema


def register_views(views: dict[str, DataFrame]) -> None:
    """Make the views available to SQL; they are recomputed on every query."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def write_views(views: dict[str, DataFrame], folder: str) -> None:
    """Store the views as ``folder/<view>.parquet`` for reporting tools."""
    for name, df in views.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def declared_schemas(tables: RetailTables, as_of: date) -> dict[str, StructType]:
    """The columns of every view as its definition gives them; nothing is computed."""
    return {name: df.schema for name, df in build_views(tables, as_of).items()}


def registered_views(
    spark: SparkSession, declared: dict[str, StructType]
) -> dict[str, DataFrame]:
    """The views of the session catalog, with the declared columns.

    A missing view, or one with other columns or types, is an error that names them.
    """
    return {
        name: check_schema(name, spark.table(name), schema) for name, schema in declared.items()
    }


def written_views(
    spark: SparkSession, folder: str, declared: dict[str, StructType]
) -> dict[str, DataFrame]:
    """The views stored in a folder, read with the declared columns.

    What the files hold is compared with the declaration first.
    """
    views = {}
    for name, schema in declared.items():
        path = f"{folder}/{name}.parquet"
        check_schema(name, spark.read.parquet(path), schema)
        views[name] = spark.read.schema(schema).parquet(path)
    return views
