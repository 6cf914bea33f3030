"""Points joined with intervals of any bounds, against a nested loop."""

import random

import pytest
from pyspark.sql import functions as F

from orderlens.operators import ranges


def frames(spark, points, intervals):
    return (
        spark.createDataFrame(points, "p long, name string"),
        spark.createDataFrame(intervals, "a long, z long, k long"),
    )


def by_definition(points, intervals):
    return sorted(
        (
            (p, n, a, z, k)
            for p, n in points
            for a, z, k in intervals
            if None not in (p, a, z) and a <= p <= z
        ),
        key=repr,
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_intervals(spark, seed):
    """Short and long ones, negative bounds, repeated rows, NULLs, ends before beginnings."""
    r = random.Random(seed)
    spread = 10 ** r.randrange(1, 12)
    points = [(r.randrange(-spread, spread), "x") for _ in range(300)] + [(None, "none"), (5, "x")] * 2
    intervals = []
    for k in range(120):
        a = r.randrange(-spread, spread)
        intervals.append((a, a + r.choice([-3, 0, 1, 2, 7, spread // 50, spread]), k))
    intervals += [(None, 5, 900), (1, None, 901), (-(2**61), 2**61, 902), intervals[0]]
    found = ranges.points_in_intervals(*frames(spark, points, intervals), "p", "a", "z")
    assert sorted(map(tuple, found.collect()), key=repr) == by_definition(points, intervals)


def test_levels_and_bins(spark):
    """Each interval touches two bins of its level at most."""
    lengths = [1, 2, 3, 4, 5, 7, 8, 9, 1023, 1024, 1025, 2**40]
    df = spark.createDataFrame([(a, a + n - 1) for n in lengths for a in range(-9, 9)], "a long, z long")
    level = ranges._level(F.col("a"), F.col("z"))
    rows = df.select("a", "z", level.alias("level")).collect()
    for r in rows:
        assert 2 ** r["level"] >= r["z"] - r["a"] + 1 > 2 ** (r["level"] - 1) / 1
        assert (r["z"] >> r["level"]) - (r["a"] >> r["level"]) <= 1


def test_no_nested_loop(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    points, intervals = frames(spark, [(1, "x")], [(0, 3, 1)])
    joined = ranges.points_in_intervals(points, intervals, "p", "a", "z")
    assert joined.count() == 1
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_sides_and_shared_names(spark):
    points, intervals = frames(spark, [(1, "x")], [(0, 3, 1)])
    for one, two in ((points.limit(0), intervals), (points, intervals.limit(0))):
        assert ranges.points_in_intervals(one, two, "p", "a", "z").count() == 0
    with pytest.raises(ValueError, match="columns named"):
        ranges.points_in_intervals(points, intervals.withColumn("P", F.lit(1)), "p", "a", "z")
