"""An append-only record of the totals of every run.

The source changes between runs, so totals of the same report differ from run to
run. The ledger keeps the totals of each run next to the as-of date and a
fingerprint of the source, and compares any two of them. Earlier runs are
evidence and are never overwritten.

A ledger is a folder with two tables. ``sources`` has one row per run and source
table: rows, and the sum and exclusive or of the rows' hashes, so that the order
of rows does not matter. ``totals`` has one row per run, view and metric and is
written last, so a run that broke off is not listed.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import checksums
from orderlens.plans.validation import pin_tables, snapshot_drift, view_totals
from orderlens.plans.views import build_views
from orderlens.sources import RetailTables

TOTALS = "as_of date, recorded_at timestamp, view_name string, metric string, value decimal(38,6), run_id string"
SOURCES = (
    "as_of date, table_name string, row_count bigint, hash_sum decimal(38,0), hash_xor bigint, "
    "run_id string"
)


def fingerprints(tables: RetailTables) -> DataFrame:
    """One row per table: its name and the checksum of its rows."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(*checksums.of_rows(sorted(df.columns))).select(
                F.lit(name).alias("table_name"), *checksums.PARTS
            )
            for name, df in tables.named().items()
        ],
    )


class Ledger:
    """The runs recorded in one folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def totals(self, run_id: str | None = None) -> DataFrame:
        """The totals of one run, or of all."""
        rows = self._table("totals", TOTALS)
        return rows if run_id is None else rows.filter(F.col("run_id") == run_id)

    def sources(self, run_id: str | None = None) -> DataFrame:
        """The fingerprints of the source tables of one run, or of all."""
        rows = self._table("sources", SOURCES)
        return rows if run_id is None else rows.filter(F.col("run_id") == run_id)

    def runs(self) -> DataFrame:
        """One row per complete run: its as-of date, when it ran, and its source's fingerprint."""
        complete = self.totals().groupBy("run_id", "as_of").agg(
            F.min("recorded_at").alias("recorded_at")
        )
        listed = F.struct("table_name", checksums.as_text().alias("checksum"))
        text = F.transform(
            F.array_sort(F.collect_list(listed)),
            lambda t: F.concat_ws("=", t["table_name"], t["checksum"]),
        )
        # Four source tables a run.
        sources = self.sources().groupBy("run_id").agg(F.array_join(text, " ").alias("source"))
        return complete.join(sources, "run_id")

    def record(
        self, run_id: str, tables: RetailTables, as_of: date, pinned: bool = False
    ) -> None:
        """Compute the views and add their totals under a new run id.

        All totals and the fingerprint come from one reading of the source;
        ``pinned`` tells that the tables are stored already.
        """
        if not self.totals(run_id).isEmpty():
            raise ValueError(f"run {run_id!r} is recorded already")
        source = tables if pinned else pin_tables(tables, as_of)
        named = [F.lit(as_of).alias("as_of"), F.lit(run_id).alias("run_id")]
        # A run that broke off before may have left fingerprints; these replace them.
        fingerprints(source).select("*", *named).write.option(
            "partitionOverwriteMode", "dynamic"
        ).mode("overwrite").partitionBy("run_id").parquet(f"{self.folder}/sources")
        view_totals(build_views(source, as_of)).select(
            "*", F.current_timestamp().alias("recorded_at"), *named
        ).write.mode("append").partitionBy("run_id").parquet(f"{self.folder}/totals")

    def compare(self, earlier: str, later: str) -> DataFrame:
        """Every total of two runs side by side and whether it drifted."""
        for run_id in (earlier, later):
            if self.totals(run_id).isEmpty():
                raise ValueError(f"no run {run_id!r}")
        return snapshot_drift(self.totals(earlier), self.totals(later))

    def changed_sources(self, earlier: str, later: str) -> DataFrame:
        """The source tables of two runs and whether their rows differ."""
        before, after = (
            self.sources(run).select("table_name", *[F.col(p).alias(f"{side}_{p}") for p in checksums.PARTS])
            for side, run in (("earlier", earlier), ("later", later))
        )
        same = [F.col(f"earlier_{p}").eqNullSafe(F.col(f"later_{p}")) for p in checksums.PARTS]
        return before.join(after, "table_name", "full").select(
            "table_name",
            "earlier_row_count",
            "later_row_count",
            (~reduce(lambda a, b: a & b, same)).alias("changed"),
        )
