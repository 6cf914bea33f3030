"""Joins of many rows with their parents in which no key is one task.

The rows of every key are counted first. The keys that hold more than a share of
all rows are few, as there are not more than one for each share. Their rows are
dealt into parts, and their parent rows, and no others, are copied to each part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import input_bytes

# A key is hot if more than one row of so many has it.
SHARE = 1000


def frequent(df: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """(hot_key, parts): keys with more than one in ``share`` rows, and their shares.

    At most ``share`` rows. NULL is a key like any other.
    """
    counts = df.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    parts = F.ceil(F.col("rows") * share / total).cast("int")
    return counts.select("hot_key", parts.alias("parts")).filter("parts > 1")


def _small(df: DataFrame) -> bool:
    """Whether the optimizer will send the whole table to every task."""
    setting = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip()
    if setting.startswith("-"):
        # A negative size turns broadcasting off; the parser of sizes refuses it.
        return False
    limit = int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting))
    size = input_bytes(df)
    return size is not None and size <= limit


def join_parents(
    df: DataFrame,
    parents: DataFrame,
    key: str,
    parent_key: str,
    how: str = "inner",
    share: int = SHARE,
) -> DataFrame:
    """Join rows with their parents, hot keys in parts.

    ``how`` is ``inner`` or ``left``. Equal to a plain join on the keys: a row is
    in one part, its parents in all. Parents that are small enough for every
    task to hold are joined without any dealing. ``df`` is read twice, the first
    time for its keys alone.
    """
    if how not in ("inner", "left"):
        raise ValueError("parents may only be joined to the side that is dealt")
    matches = F.col(key) == F.col(parent_key)
    if _small(parents):
        return df.join(parents, matches, how)
    hot = F.broadcast(frequent(df, key, share))
    # A repeated task deals its rows as before.
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("parts"))
    rows = df.join(hot, F.col(key).eqNullSafe(F.col("hot_key")), "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.coalesce(dealt, F.lit(0)).cast("int").alias("__part"),
    )
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    copies = parents.join(hot, F.col(parent_key) == F.col("hot_key"), "left").select(
        *[F.col(f"`{c}`") for c in parents.columns],
        F.explode(F.sequence(F.lit(0), last)).alias("__copy"),
    )
    joined = rows.join(copies, matches & (F.col("__part") == F.col("__copy")), how)
    return joined.drop("__part", "__copy")
