"""Order-insensitive comparison of a Spark frame with a DuckDB result."""

from __future__ import annotations

import duckdb

TABLES = ("orders", "lineitem", "part", "customer")

SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(df, con, sql) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    types = {n: SPARK_TO_DUCKDB.get(t, t) for n, t in df.dtypes}
    if types != expected_types:
        return f"types {sorted(set(types.items()) ^ set(expected_types.items()))}"
    expected = normal(result.fetchall(), [d[0] for d in result.description])
    actual = normal(df.collect(), df.columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{sorted(df.columns)}: {a} expected {e}"
    return None
