"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Event dates are UTC dates. A join whose output feeds an aggregation on the
# same key is only split at a hot key when the skew rule may add a shuffle, so
# that is allowed explicitly.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the reports rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# One shuffle partition per this much input.
PARTITION_BYTES = 128 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZED = "orderlens.shuffles.sized"


def input_bytes(df: DataFrame) -> int | None:
    """Size of the files behind a frame, as the optimizer knows it; None if it does not."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return None if any(size >= UNKNOWN_BYTES for size in sizes) else sum(sizes)


def partitions_for(total: int, partition_bytes: int | None = None) -> int:
    """Shuffle partitions for so many bytes; there is no upper limit."""
    return max(1, -(-total // (partition_bytes or PARTITION_BYTES)))


def size_shuffles(
    spark: SparkSession, *tables: DataFrame, partition_bytes: int | None = None
) -> None:
    """Start shuffles with enough partitions for the input.

    Adaptive execution merges small ones afterwards. A number chosen by the
    user stays, and so does the configured one where it is large enough. A
    table of unknown size gives a warning and leaves the setting as it is.
    """
    chosen = spark.conf.get(INITIAL_PARTITIONS, None)
    if chosen is not None and chosen != spark.conf.get(SIZED, None):
        return
    sizes = [input_bytes(t) for t in tables]
    if None in sizes:
        warnings.warn("a table has no known size; set " + INITIAL_PARTITIONS, stacklevel=2)
        return
    wanted = partitions_for(sum(sizes), partition_bytes)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
        spark.conf.set(SIZED, str(wanted))
    elif chosen is not None:
        spark.conf.unset(INITIAL_PARTITIONS)
        spark.conf.unset(SIZED)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where that is unset, a local session uses its warehouse folder. A cluster
    session without it is an error: a machine-local folder would lose data with
    its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir")


def _stored(spark: SparkSession) -> str:
    folder = shared_folder(spark).rstrip("/")
    return f"{folder}/orderlens/{spark.sparkContext.applicationId}"


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# The folders made inside each open scope, the innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Own the tables stored inside the block and remove them at its end, also after an error.

    Frames that read them must have been used, or written elsewhere, by then.
    Scopes may be nested; each removes what was stored in it alone.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for folder in _SCOPES.pop():
            _remove(spark, folder)


def scratch(spark: SparkSession, label: str) -> str:
    """The name of a new folder beside the stored tables, removed with them."""
    folder = f"{_stored(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(folder)
    return folder


def discard(stored: DataFrame) -> None:
    """Remove a stored table that no frame reads any more."""
    spark = stored.sparkSession
    own = _stored(spark).removeprefix("file:")
    folders = {file.rsplit("/", 1)[0] for file in stored.inputFiles()}
    for folder in folders:
        if own in folder:
            _remove(spark, folder)


def release(spark: SparkSession) -> None:
    """Remove all tables that this application has stored.

    Call it when no frame that reads them is needed any more.
    """
    _remove(spark, _stored(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table.

    Used where a frame is read several times and recomputing it would repeat
    the scan of the large tables. The stored copy outlives executors, keeps
    column pruning and gives the optimizer true sizes.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
