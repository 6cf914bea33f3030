"""Stored sketches merged for any period, against exact ranks."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderlens.operators import sketches

PERCENTS = {"low": 1, "middle": 50, "high": 99}


def rank_range(values, x):
    """Shares of the values below and up to x."""
    return sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    made = []
    for _ in range(60_000):
        # A third of the rows share a month, a third a price.
        month = 3 if r.random() < 0.34 else r.randrange(1, 13)
        price = 20.0 if r.random() < 0.34 else round(r.paretovariate(1.1) * 7, 2)
        made.append((r.choice("ab"), datetime(2001, month, 5), None if r.random() < 0.02 else price))
    return made


@pytest.fixture(scope="module")
def stored(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sketches"))
    df = spark.createDataFrame(rows, "kind string, at timestamp, price double")
    sketches.monthly_sketches(df, "at", "price", ("kind",)).write.parquet(f"{path}/months")
    return spark.read.parquet(f"{path}/months")


@pytest.mark.parametrize("first, last", [(1, 12), (3, 3), (5, 9)])
def test_any_period(stored, rows, first, last):
    bounds = [F.lit(datetime(2001, m, 1).date()) for m in (first, last)]
    for by in ((), ("kind",)):
        for found in sketches.period_points(stored, PERCENTS, *bounds, by).collect():
            values = [
                p for k, t, p in rows
                if p is not None and first <= t.month <= last and (not by or k == found["kind"])
            ]
            assert found["values"] == len(values)
            for name, percent in PERCENTS.items():
                below, upto = rank_range(values, found[name])
                assert below - sketches.RANK_ERROR <= percent / 100 <= upto + sketches.RANK_ERROR


def test_sketches_stay_small(stored):
    sizes = stored.agg(F.max(F.octet_length("sketch"))).first()[0]
    assert sizes < 40 * sketches.SIZE


def test_no_values_and_no_times(spark):
    rows = [(None, 1.0), (datetime(2001, 1, 2), None), (datetime(2001, 2, 2), 5.0)]
    df = spark.createDataFrame(rows, "at timestamp, price double")
    months = sketches.monthly_sketches(df, "at", "price")
    found = {r["month"].month: (r["values"], r["middle"]) for r in sketches.points(months, PERCENTS).collect()}
    assert found == {1: (0, None), 2: (1, 5.0)}
    assert sketches.period_points(months, PERCENTS).first()["middle"] == 5.0
    assert sketches.merged(months.limit(0), ("month",)).count() == 0
