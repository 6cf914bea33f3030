"""Row functions over Arrow batches, with bounded batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Rows that go to a Python worker at once; long texts make large batches.
BATCH_ROWS = 512
# Characters that a library call gets at once.
SLICE_CHARS = 1 << 19

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp(prefix="orderlens-code-")) / "orderlens.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def by_rows(
    df: DataFrame, make: Callable[[], Callable[[Iterator[dict]], Iterable[dict]]], schema: str
) -> DataFrame:
    """Run ``make()`` once per task and send the task's rows through its result.

    Rows come and go as dictionaries, a bounded batch at a time.
    """
    spark = df.sparkSession
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    ship(spark)
    target = _arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()

        def rows() -> Iterator[dict]:
            for batch in batches:
                yield from batch.to_pylist()

        out: list[dict] = []
        held = 0
        for row in work(rows()):
            out.append(row)
            held += sum(len(v) for v in row.values() if isinstance(v, str | bytes | list))
            if len(out) >= BATCH_ROWS or held >= 8 * SLICE_CHARS:
                yield pa.RecordBatch.from_pylist(out, schema=target)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return df.mapInArrow(task, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def sliced(rows: Iterator[dict], text: str) -> Iterator[list[dict]]:
    """Lists of rows whose texts have about ``SLICE_CHARS`` characters together."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[text] or "")
        if size >= SLICE_CHARS or len(held) >= BATCH_ROWS:
            yield held
            held, size = [], 0
    if held:
        yield held


def kept_fields(docs: DataFrame, schema: str) -> list[str]:
    """Names of the columns that results of this schema do not replace."""
    from pyspark.sql.types import StructType

    names = {f.name.lower() for f in StructType.fromDDL(schema).fields}
    return [c for c in docs.columns if c.lower() not in names]


def with_schema(docs: DataFrame, schema: str) -> str:
    """The schema of the kept columns followed by the results."""
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(schema).fields
    fields = [docs.schema[name] for name in kept_fields(docs, schema)] + added
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def with_results(docs: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Add the columns of ``schema`` that ``make()`` computes from each row.

    They replace columns of the same names; all other columns pass through.
    """
    kept = kept_fields(docs, schema)

    def task():
        results = make()

        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for row in rows:
                yield {name: row[name] for name in kept} | results(row)

        return work

    return by_rows(docs, task, with_schema(docs, schema))
