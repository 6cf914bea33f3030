"""Ranks and quantiles against brute force, with values shared by a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from orderlens.operators import ordering
from orderlens.plans import views


def values(seed, n=600):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        group = r.choice(["a", "a", "a", "b", "c", None])
        value = 500 if r.random() < 0.34 else r.randint(0, 5000)
        rows.append((group, None if r.random() < 0.05 else value))
    return rows


def cells_of(spark, rows):
    df = spark.createDataFrame(rows, "category string, value long")
    return df.groupBy("category", "value").agg(F.count("*").alias("n"))


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks(spark, seed):
    rows = values(seed)
    cells = cells_of(spark, rows).withColumn("bucket", ordering.magnitude("value"))
    assert cells.select("bucket").distinct().count() > 5
    ranked = ordering.with_ranks(
        cells, "value", "n", "bucket", {"overall": [], "within": ["category"]}
    )

    def rank(value, among):
        return 1 + sum((v is not None and value is None) or
                       (v is not None and value is not None and v > value) for v in among)

    found = ranked.collect()
    assert len(found) == len(set(rows))
    for row in found:
        assert row["overall"] == rank(row["value"], [v for _, v in rows])
        assert row["within"] == rank(
            row["value"], [v for c, v in rows if c == row["category"]]
        )


@pytest.mark.parametrize("seed", [3, 4])
def test_quantiles(spark, seed):
    rows = values(seed) + [("only nulls", None)] * 3 + [("single", 42)]
    weighted = (
        cells_of(spark, rows)
        .withColumn("weight", F.when(F.col("value").isNull(), 0).otherwise(F.col("n")))
        .withColumn("bucket", F.floor(F.col("value") / 100))
    )
    percents = {"low": 1, "middle": 50, "high": 90, "top": 99}
    found = {
        r["category"]: r
        for r in ordering.quantiles(
            weighted, "value", "weight", ["category"], "bucket", percents
        ).collect()
    }
    for category in {c for c, _ in rows}:
        known = sorted(v for c, v in rows if c == category and v is not None)
        if not known:
            assert category not in found
            continue
        for name, percent in percents.items():
            position = max(1, -(-len(known) * percent // 100))
            assert found[category][name] == known[position - 1], (category, name)


@pytest.mark.parametrize("kind", ["double", "decimal(38,9)", "bigint"])
def test_buckets_are_ordered(spark, kind):
    """Neighbouring values, signs, zero and NULL, over many sizes."""
    r = random.Random(7)
    numbers = [0, 1, -1]
    for size in range(-8, 27):
        for _ in range(20):
            number = r.choice([-1, 1]) * r.random() * 10.0**size
            numbers += [number, number * (1 + 2e-16), number * (1 + 1e-9)]
    df = spark.createDataFrame([(float(n),) for n in numbers], "n double")
    df = df.select(F.expr(f"try_cast(n AS {kind})").alias("n"))
    df = df.union(df.select(F.lit(None).cast(kind))).withColumn("bucket", ordering.magnitude("n"))
    rows = df.distinct().orderBy(F.asc_nulls_first("n")).collect()
    buckets = [row["bucket"] for row in rows]
    assert buckets == sorted(buckets) and buckets[0] < buckets[1]
    if kind == "double":
        assert len(set(buckets)) > 600


def test_buckets_follow_the_values(spark):
    """Prices around any level are dealt over many buckets."""
    for level in (0.05, 40, 10**9):
        spread = spark.range(10_000).select((F.rand(1) * level + level).alias("value"))
        sizes = spread.groupBy(ordering.magnitude("value").alias("b")).count()
        assert sizes.agg(F.max("count")).first()[0] < 20


def by_ranks(rows):
    """(overall, within) rank of every product, NULL revenue last."""
    def rank(value, among):
        return 1 + sum(v is not None and (value is None or v > value) for v in among)

    return {
        i: (rank(v, [w for _, w in rows]), rank(v, [w for d, w in rows if d == c]))
        for i, (c, v) in enumerate(rows)
    }


def test_product_ranking_with_equal_revenues_and_unknown_categories(spark):
    data = values(5, 300) + [(None, None), ("a", 0), ("a", -3), ("b", -3)]
    totals = spark.createDataFrame(
        [(i, f"n{i}", c, 1, 1, v, 1.0, 1.0) for i, (c, v) in enumerate(data)],
        "id long, name string, category string, completed_orders long, completed_items long, "
        "recognized_revenue long, estimated_product_cost double, estimated_gross_profit double",
    )
    found = views._ranked(totals).collect()
    assert {
        r["id"]: (r["overall_revenue_rank"], r["category_revenue_rank"]) for r in found
    } == by_ranks(data)
    revenue = {}
    for c, v in data:
        revenue[c] = revenue.get(c, 0) + (v or 0)
    assert {r["all_revenue"] for r in found} == {sum(revenue.values())}
    assert {r["category"]: r["category_revenue"] for r in found} == revenue
