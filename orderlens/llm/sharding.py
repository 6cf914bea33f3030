"""Sharding by weighted rendezvous hashing of a stable record key.

Every record goes to the shard with the least ``-ln(u) / weight``, where ``u``
is a hash of key and shard number in (0, 1). The shard follows from key and
shards alone; a shard that is added only takes records, none moves between the
others. Assigning moves no rows.

Slots number the records of a shard from 0 without gaps, ordered by the key's
hash. A shard is never one task: it is cut into ranges of that hash, each
range is numbered on its own and starts at the count of the ranges before it.
Equal records are counted before they are shuffled, so a key that holds a large
part of all rows is one row there.

Defined results: a null key is a key of its own; a null text has size 8 and the
checksum of the empty text; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import text_or_empty, unused

SHARDS = 24
ROW_BYTES = 8
# Ranges of a shard for each shuffle partition, so that ranges stay small.
RANGES_PER_PARTITION = 4


def _unit(key: Column, shard: int) -> Column:
    """A hash of key and shard as a number strictly between 0 and 1."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def _least(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    return F.array_min(
        F.array(
            *[
                F.struct(
                    (-F.log(_unit(key, first + i)) / float(weight)).alias("cost"),
                    F.lit(first + i).alias("shard"),
                )
                for i, weight in enumerate(weights)
            ]
        )
    )


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among shards of these weights."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("shards need positive weights")
    return _least(key, weights)["shard"]


def assign(df: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """Add the shard of every row; no row moves."""
    return df.withColumn(name, shard_of(F.col(f"`{key}`"), weights))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], folder: str) -> None:
    """Write one folder per shard; tasks write what they hold, nothing is shuffled."""
    name = unused(df, "shard")
    assign(df, key, weights, name).write.partitionBy(name).mode("overwrite").parquet(folder)


def number(df: DataFrame, key: str, shard: str, ties: Sequence[str]) -> DataFrame:
    """One row per record with its ``slot``; the columns are key, shard and ties.

    Records that are equal in these columns are interchangeable.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, math.ceil(math.log2(partitions * RANGES_PER_PARTITION)))
    columns = list(dict.fromkeys([key, shard, *ties]))
    place = F.xxhash64(F.col(f"`{key}`"))
    records = (
        df.groupBy(*[F.col(f"`{c}`") for c in columns])
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__place", place)
        .withColumn("__range", F.shiftrightunsigned(F.col("__place"), 64 - bits))
    )
    # At most 2**bits rows for each shard.
    sizes = records.groupBy(shard, "__range").agg(F.sum("__n").alias("__size"))
    before = Window.partitionBy(shard).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        shard, "__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
    )
    inside = (
        Window.partitionBy(shard, "__range")
        .orderBy(F.col("__place"), *[F.col(f"`{c}`") for c in columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("__start") + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    return (
        records.join(starts, [shard, "__range"])
        .withColumn("__first", first)
        .select(
            *[F.col(f"`{c}`") for c in columns],
            F.explode(
                F.sequence(F.col("__first"), F.col("__first") + F.col("__n") - 1)
            ).alias("slot"),
        )
    )


def records(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size in bytes and unsigned checksum of every document."""
    whole = text_or_empty(text)
    return docs.select(
        F.col(f"`{key}`"),
        (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + ROW_BYTES)
        .cast("long")
        .alias("size"),
        F.crc32(whole.cast("binary")).cast("long").alias("text_crc32"),
    )


def plan(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """Shard, slot and the shard after one more of mean weight for every document."""
    grown = [*weights, sum(weights) / len(weights)]
    placed = assign(records(docs, key), key, weights)
    numbered = number(placed, key, "shard", ("size", "text_crc32"))
    return numbered.withColumn("grown_shard", shard_of(F.col(f"`{key}`"), grown))
