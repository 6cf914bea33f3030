"""Where two states of a table differ, by a tree of checksums.

The checksum of some rows is their number and the sum and the exclusive or of
their hashes. It does not depend on the order of rows, and those of parts add up
to that of the whole. A tree of a table stores the checksums of its months, of
its days and of its keys, the latter in one partition for each month. Two trees
are compared from the top: days are read of months that differ, and keys of the
partitions of such months only, there of days that differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import checksums

# Name of the month of rows without a time.
NO_MONTH = "none"
SIDES = ("earlier", "later")


class ChecksumTree:
    """Stored checksums of one state of a table.

    ``state`` names one of several states that were stored together.
    """

    def __init__(
        self, spark: SparkSession, folder: str, key: list[str], state: str | None = None
    ) -> None:
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key
        self.state = state

    @classmethod
    def store(cls, df: DataFrame, folder: str, key: list[str], time: str) -> ChecksumTree:
        """Read ``df`` once and store the tree of its rows under ``folder``.

        ``time`` places a row in the tree and should be a time that does not
        change, such as that of creation. A key may have any number of rows.
        """
        tree = cls(df.sparkSession, folder, key)
        tree._write_keys(tree._hashed(df, time), [])
        tree._write_upper()
        return tree

    @classmethod
    def store_states(
        cls, states: dict[str, DataFrame], folder: str, key: list[str], time: str
    ) -> list[ChecksumTree]:
        """Store the trees of several states of a table in one job, as ``store`` does one.

        What the states are made of in the same way, such as a join, is shuffled once.
        """
        spark = next(iter(states.values())).sparkSession
        trees = [cls(spark, folder, key, state) for state in states]
        marked = [
            tree._hashed(df, time).withColumn("state", F.lit(tree.state))
            for tree, df in zip(trees, states.values())
        ]
        cls(spark, folder, key)._write_keys(reduce(DataFrame.unionByName, marked), ["state"])
        for tree in trees:
            tree._write_upper()
        return trees

    def _hashed(self, df: DataFrame, time: str) -> DataFrame:
        """The day, key and hash of every row."""
        return df.select(
            F.to_date(F.col(time)).alias("tree_day"),
            *[F.col(f"`{c}`").alias(f"key_{i}") for i, c in enumerate(self.key)],
            checksums.row_hash(sorted(df.columns)).alias("row_hash"),
        )

    def _write_keys(self, hashed: DataFrame, by: list[str]) -> None:
        """Store the checksums of keys; rows are shuffled once, as hashes, to their days."""
        names = [f"key_{i}" for i in range(len(self.key))]
        placed = (
            hashed.repartition(*by, "tree_day")
            .groupBy(*by, "tree_day", *names)
            .agg(*checksums.of_hashes(F.col("row_hash")))
        )
        # Sum and exclusive or of a single row are both its hash, which is stored once.
        several = F.when(F.col("row_count") > 1, F.col("hash_sum"))
        month = F.coalesce(F.date_format("tree_day", "yyyy-MM"), F.lit(NO_MONTH))
        placed = placed.withColumn("hash_sum", several).withColumn("tree_month", month)
        # One empty file that holds the types, also of an empty table.
        placed.limit(0).coalesce(1).write.parquet(f"{self.folder}/types")
        placed.sortWithinPartitions(*by, "tree_month", "tree_day", *names).write.partitionBy(
            *by, "tree_month"
        ).parquet(f"{self.folder}/keys")

    def _write_upper(self) -> None:
        """Store the checksums of days and months, made from those of keys."""
        self._keys().groupBy("tree_month", "tree_day").agg(*checksums.of_parts()).write.parquet(
            self._path("days")
        )
        self.days().groupBy("tree_month").agg(*checksums.of_parts()).coalesce(1).write.parquet(
            self._path("months")
        )

    def _path(self, level: str) -> str:
        part = "" if self.state is None else f"/state={self.state}"
        return f"{self.folder}/{level}{part}"

    def months(self) -> DataFrame:
        return self.spark.read.parquet(self._path("months"))

    def days(self) -> DataFrame:
        return self.spark.read.parquet(self._path("days"))

    def _keys(self) -> DataFrame:
        types = self.spark.read.parquet(f"{self.folder}/types").schema
        stored = self.spark.read.schema(types).parquet(f"{self.folder}/keys")
        if self.state is not None:
            stored = stored.filter(F.col("state") == self.state).drop("state")
        single = F.col("hash_xor").cast("decimal(38,0)")
        return stored.withColumn("hash_sum", F.coalesce("hash_sum", single))

    def keys(self, months: list[str]) -> DataFrame:
        """The checksums of the keys of these months; other months are not read."""
        return self._keys().filter(F.col("tree_month").isin(months))


def _compared(earlier: DataFrame, later: DataFrame, by: list[str]) -> DataFrame:
    """Checksums of both sides on one row, and whether they differ."""
    marked = [
        df.select(*by, F.lit(side).alias("side"), *checksums.PARTS)
        for side, df in zip(SIDES, (earlier, later))
    ]

    def of(side: str, part: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(part)))

    # A place has one checksum a side at most; grouping takes NULL for a value.
    both = marked[0].unionByName(marked[1]).groupBy(*by).agg(
        *[of(s, p).alias(f"{s}_{p}") for s in SIDES for p in checksums.PARTS]
    )
    same = [F.col(f"earlier_{p}").eqNullSafe(F.col(f"later_{p}")) for p in checksums.PARTS]
    rows = [
        F.coalesce(f"{side}_row_count", F.lit(0)).cast("bigint").alias(f"{side}_rows")
        for side in SIDES
    ]
    return both.select(*by, *rows, (~reduce(lambda a, b: a & b, same)).alias("differs"))


def locate(earlier: ChecksumTree, later: ChecksumTree) -> DataFrame:
    """Where two states differ, as rows of one list.

    ``level`` is ``month`` for a month without a difference, ``day`` for a day
    without one in another month, and ``key`` for a key whose rows differ, with
    ``change`` telling whether it was added, removed or changed. ``month`` is
    the month's first day; rows without a time have neither month nor day.
    """
    if earlier.key != later.key:
        raise ValueError("the trees have different keys")
    names = [f"key_{i}" for i in range(len(later.key))]
    kinds = {f.name: f.dataType for f in later.keys([]).schema.fields}
    months = _compared(earlier.months(), later.months(), ["tree_month"])
    # As many rows as there are months.
    found = [r["tree_month"] for r in months.filter("differs").collect()]
    inside = F.col("tree_month").isin(found)
    by_day = ["tree_month", "tree_day"]
    days = _compared(earlier.days().filter(inside), later.days().filter(inside), by_day)
    changed_days = days.filter("differs").select(*by_day)

    def of_changed_days(tree: ChecksumTree) -> DataFrame:
        keys, day = tree.keys(found), changed_days.select(F.col("tree_day").alias("of_day"))
        return keys.join(day, F.col("tree_day").eqNullSafe(F.col("of_day")), "left_semi")

    keys = _compared(of_changed_days(earlier), of_changed_days(later), [*by_day, *names])
    change = (
        F.when(F.col("earlier_rows") == 0, "added")
        .when(F.col("later_rows") == 0, "removed")
        .otherwise("changed")
    )

    def listed(df: DataFrame, level: str, change: Column, day: bool, key: bool) -> DataFrame:
        return df.select(
            F.lit(level).alias("level"),
            F.to_date(
                F.when(F.col("tree_month") != NO_MONTH, F.concat("tree_month", F.lit("-01")))
            ).alias("month"),
            (F.col("tree_day") if day else F.lit(None).cast("date")).alias("day"),
            *[
                (F.col(n) if key else F.lit(None).cast(kinds[n])).alias(c)
                for n, c in zip(names, later.key)
            ],
            change.alias("change"),
            "earlier_rows",
            "later_rows",
        )

    return (
        listed(months.filter("NOT differs"), "month", F.lit("none"), False, False)
        .unionByName(listed(days.filter("NOT differs"), "day", F.lit("none"), True, False))
        .unionByName(listed(keys.filter("differs"), "key", change, True, True))
    )


def touched_months(earlier: ChecksumTree, later: ChecksumTree) -> list[str]:
    """The months, as yyyy-MM, in which two states differ."""
    months = _compared(earlier.months(), later.months(), ["tree_month"])
    return sorted(r["tree_month"] for r in months.filter("differs").collect())
