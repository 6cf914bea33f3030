"""What the source tables are declared to be, for the readers and for checks of what is stored."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaDrift(ValueError):
    """A stored table does not have its declared columns."""

    def __init__(self, table: str, drift: list[tuple[str, str, str]]) -> None:
        self.table, self.drift = table, drift
        listed = "; ".join(f"{c}: declared {d}, found {f}" for c, d, f in drift)
        super().__init__(f"{table}: {listed}")


def schema_drift(found: StructType, declared: StructType) -> list[tuple[str, str, str]]:
    """(column, declared type, found type) of every column that differs.

    A column on one side only has the type ``none`` on the other. Columns are
    compared by name; their order does not matter, nor whether they may be NULL.
    """
    ours = {f.name.lower(): f for f in declared.fields}
    theirs = {f.name.lower(): f for f in found.fields}
    drift = []
    for key in dict.fromkeys([*ours, *theirs]):
        mine, other = (
            side[key].dataType.simpleString() if key in side else "none" for side in (ours, theirs)
        )
        if mine != other:
            drift.append(((ours.get(key) or theirs[key]).name, mine, other))
    return drift


def check_schema(table: str, df: DataFrame, declared: StructType) -> DataFrame:
    """The declared columns of ``df``, or an error that names those that differ."""
    drift = schema_drift(df.schema, declared)
    if drift:
        raise SchemaDrift(table, drift)
    return df.select(*[f.name for f in declared.fields])


@dataclass(frozen=True)
class TableContract:
    """Columns with their types, which of them are always filled, and the key of a table."""

    columns: str
    key: tuple[str, ...]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def filled(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


# The columns of the four tables. Prices may be stored as another
# type; then ``with_types`` states it.
EVENTS = "shipped_at timestamp, delivered_at timestamp, returned_at timestamp"
RETAIL = {
    "orders": TableContract(
        "order_id bigint NOT NULL, user_id bigint, status string NOT NULL, "
        f"created_at timestamp NOT NULL, {EVENTS}, num_of_item bigint",
        ("order_id",),
    ),
    "order_items": TableContract(
        "id bigint NOT NULL, order_id bigint NOT NULL, user_id bigint, product_id bigint, "
        f"status string NOT NULL, created_at timestamp, {EVENTS}, sale_price double",
        ("id",),
    ),
    "products": TableContract(
        "id bigint NOT NULL, name string, category string, cost double, retail_price double",
        ("id",),
    ),
    "users": TableContract("id bigint NOT NULL", ("id",)),
}


def with_types(contracts: dict[str, TableContract], **types: str) -> dict[str, TableContract]:
    """The contracts with other types for some columns, by column name, in every table."""

    def changed(contract: TableContract) -> TableContract:
        fields = [
            f"`{f.name}` {types.get(f.name, f.dataType.simpleString())}"
            + ("" if f.nullable else " NOT NULL")
            for f in contract.schema.fields
        ]
        return TableContract(", ".join(fields), contract.key)

    return {name: changed(contract) for name, contract in contracts.items()}


def stored_drift(
    spark: SparkSession,
    folder: str,
    contracts: dict[str, TableContract] | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """(table_name, column_name, declared, found) of every column stored otherwise.

    Reads what the files say about themselves, not their rows. Columns that no
    contract names are listed as declared ``none``.
    """
    rows = [
        (name, *drift)
        for name, contract in (contracts or RETAIL).items()
        for drift in schema_drift(
            spark.read.format(file_format).load(f"{folder}/{name}.{file_format}").schema,
            contract.schema,
        )
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, declared string, found string"
    )


def violations(
    tables: dict[str, DataFrame], contracts: dict[str, TableContract] | None = None
) -> DataFrame:
    """(table_name, rule, column_name, violating_rows) of every rule of the contracts.

    ``filled`` counts the NULLs of columns that have none; ``unique`` counts the
    rows beyond the first of each key, in which NULL equals NULL.
    """
    frames = []
    for name, contract in (contracts or RETAIL).items():
        df = tables[name]
        counts = df.agg(
            *[F.count_if(F.col(c).isNull()).alias(c) for c in contract.filled]
        ).unpivot([], contract.filled, "column_name", "violating_rows")
        copies = df.groupBy(*contract.key).agg((F.count(F.lit(1)) - 1).alias("more"))
        unique = copies.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("violating_rows"))
        for rule, found in (
            ("filled", counts),
            ("unique", unique.withColumn("column_name", F.lit(", ".join(contract.key)))),
        ):
            frames.append(
                found.select(
                    F.lit(name).alias("table_name"),
                    F.lit(rule).alias("rule"),
                    "column_name",
                    "violating_rows",
                )
            )
    return reduce(DataFrame.unionByName, frames)
