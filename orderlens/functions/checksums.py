"""Checksums of rows that do not depend on their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a checksum consists of. Checksums of parts add up to that of the whole.
PARTS = ("row_count", "hash_sum", "hash_xor")


def row_hash(columns: list[str]) -> Column:
    """A 64-bit hash of a row; NULL differs from every value."""
    marked = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(*marked)


def of_rows(columns: list[str]) -> list[Column]:
    """Aggregates over rows: how many, and sum and exclusive or of their hashes."""
    return of_hashes(row_hash(columns))


def of_hashes(hashed: Column) -> list[Column]:
    """The same over rows that were hashed before."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.sum(hashed.cast("decimal(28,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor(hashed).alias("hash_xor"),
    ]


def of_parts() -> list[Column]:
    """Aggregates over checksums: the checksum of all their rows."""
    return [
        F.sum("row_count").alias("row_count"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"),
    ]


def as_text() -> Column:
    """A checksum in one string."""
    return F.concat_ws(":", *[F.col(p).cast("string") for p in PARTS])
