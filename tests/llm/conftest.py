import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent)]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the smallest generated table."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


@pytest.fixture
def folder(spark, tmp_path):
    """Write tables as a data folder and return its path."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
