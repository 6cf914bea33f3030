"""Runs that differ: earlier states, the ledger of totals, and where tables differ."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlens.functions import checksums
from orderlens.plans import views
from orderlens.plans.drift import ChecksumTree, locate, touched_months
from orderlens.plans.ledger import Ledger, fingerprints
from orderlens.sources import RetailTables
from orderlens.sources.history import as_known
from orderlens.sources.mapping import TEST_AS_OF, map_test_tables

SMALL = "/root/testdata/sf0.001"
ORDERS = (
    "order_id long, user_id long, status string, created_at timestamp, shipped_at timestamp, "
    "delivered_at timestamp, returned_at timestamp"
)


@pytest.fixture(scope="module")
def tables(spark):
    return map_test_tables(spark, SMALL)


def at(day):
    return None if day is None else datetime(2001, 6, day)


def test_earlier_states(spark):
    rows = [
        # id, status, created, shipped, delivered, returned -> state at the end of the 10th
        ((1, "Returned", 1, 2, 3, 4), ("Returned", 2, 3, 4)),
        ((2, "Returned", 1, 2, 3, 11), ("Complete", 2, 3, None)),
        ((3, "Returned", 1, 2, 12, 13), ("Shipped", 2, None, None)),
        ((4, "Returned", 1, 12, 13, 14), ("Processing", None, None, None)),
        ((5, "Complete", 1, 11, 12, None), ("Processing", None, None, None)),
        ((6, "Complete", 1, 9, 10, None), ("Complete", 9, 10, None)),
        ((7, "Cancelled", 1, None, None, None), ("Cancelled", None, None, None)),
        ((8, "Complete", 11, 11, 12, None), None),
        ((9, "Complete", None, 2, None, None), ("Complete", 2, None, None)),
        ((10, None, 1, 20, None, None), (None, None, None, None)),
        # A reversed pair: the state falls back as far as its events allow.
        ((11, "Complete", 1, 15, 5, None), ("Complete", None, 5, None)),
    ]
    df = spark.createDataFrame(
        [(i, 0, s, *map(at, times)) for (i, s, *times), _ in rows], ORDERS
    )
    known = as_known(RetailTables(df, df, df, df), date(2001, 6, 10)).orders
    assert known.dtypes == df.dtypes
    found = {r["order_id"]: r for r in known.collect()}
    for (key, *_), expected in rows:
        if expected is None:
            assert key not in found
        else:
            state, *times = expected
            r = found[key]
            assert (r["status"], r["shipped_at"], r["delivered_at"], r["returned_at"]) == (
                state,
                *map(at, times),
            )


def test_checksums_do_not_depend_on_order(spark):
    rows = [(i % 7, None if i % 5 == 0 else str(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "a long, b string")
    whole = df.agg(*checksums.of_rows(["a", "b"])).first()
    shuffled = df.orderBy(F.rand(3)).repartition(5)
    assert shuffled.agg(*checksums.of_rows(["a", "b"])).first() == whole
    parts = df.groupBy("a").agg(*checksums.of_rows(["a", "b"]))
    assert parts.agg(*checksums.of_parts()).first() == whole
    twice = df.union(df).agg(*checksums.of_rows(["a", "b"])).first()
    assert twice["row_count"] == 200 and twice["hash_sum"] == 2 * whole["hash_sum"]
    swapped = spark.createDataFrame([(None, 1), (1, None)], "a long, b long")
    hashes = [r[0] for r in swapped.select(checksums.row_hash(["a", "b"])).collect()]
    assert len(set(hashes)) == 2


def test_ledger(spark, tables, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.runs().count() == 0
    ledger.record("before", as_known(tables, date(2001, 5, 20)), TEST_AS_OF)
    ledger.record("now", tables, TEST_AS_OF)
    ledger.record("again", tables, TEST_AS_OF)
    runs = {r["run_id"]: r for r in ledger.runs().collect()}
    assert set(runs) == {"before", "now", "again"}
    assert runs["now"]["source"] == runs["again"]["source"] != runs["before"]["source"]
    assert runs["now"]["as_of"] == TEST_AS_OF
    drift = ledger.compare("before", "now").collect()
    assert {r["drifted"] for r in drift} == {True, False}
    for r in drift:
        assert r["drifted"] == (r["earlier_value"] != r["later_value"])
    assert not any(r["drifted"] for r in ledger.compare("now", "again").collect())
    changed = {r["table_name"]: r["changed"] for r in ledger.changed_sources("before", "now").collect()}
    assert changed == {"orders": True, "order_items": True, "products": False, "users": False}
    # Runs are kept as they are.
    before = ledger.totals("before").collect()
    with pytest.raises(ValueError, match="recorded already"):
        ledger.record("before", tables, TEST_AS_OF)
    with pytest.raises(ValueError, match="no run"):
        ledger.compare("before", "unknown")
    assert sorted(ledger.totals("before").collect()) == sorted(before)
    month = views.monthly_revenue(tables.order_items, TEST_AS_OF)
    total = month.agg(F.sum("completed_items")).first()[0]
    stored = ledger.totals("now").filter(
        "view_name = 'monthly_revenue' AND metric = 'completed_items'"
    )
    assert stored.first()["value"] == total


def test_a_run_that_broke_off_is_recorded_anew(spark, tables, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    fingerprints(tables).withColumn("as_of", F.lit(TEST_AS_OF)).withColumn(
        "run_id", F.lit("half")
    ).write.partitionBy("run_id").parquet(f"{tmp_path}/sources")
    assert ledger.runs().count() == 0
    ledger.record("half", tables, TEST_AS_OF)
    assert ledger.sources("half").count() == 4
    assert ledger.runs().count() == 1


# --- where two states differ

SCHEMA = "id string, n long, price double, made_at timestamp"


def generated(rng, n):
    start = datetime(2000, 1, 1)
    rows = []
    for i in range(n):
        made = None if rng.random() < 0.03 else start + timedelta(hours=rng.randrange(9000))
        rows.append((rng.choice([None, f"k{i}", f"k{i}", f"k{i}", "twice"]), i, rng.random(), made))
    return rows


def altered(rng, rows):
    out = []
    for row in rows:
        hit = rng.random() if row[3] and row[3].month in (3, 4) and row[3].day > 20 else 1.0
        if hit < 0.1:
            continue
        if hit < 0.2:
            row = (row[0], row[1], None, row[3])
        elif hit < 0.3:
            row = (row[0], row[1], row[2], row[3] + timedelta(days=40))
        out.append(row)
        if hit < 0.05:
            out.append(row)
    return out + [("new", 1, 2.0, datetime(2000, 3, 5)), ("new", 1, 2.0, None)]


def by_definition(before, after):
    """The list from a comparison of all rows."""
    sides = [Counter(), Counter()]
    groups = [{}, {}]
    for side, rows in enumerate((before, after)):
        for row in rows:
            day = row[3] and row[3].date()
            groups[side].setdefault((day, row[0]), []).append(row)
            sides[side][day] += 1
    places = set(groups[0]) | set(groups[1])
    differ = {
        p for p in places
        if sorted(groups[0].get(p, []), key=repr) != sorted(groups[1].get(p, []), key=repr)
    }
    month = lambda day: day and day.replace(day=1)
    days = {d for d, _ in places}
    bad_days, bad_months = {d for d, _ in differ}, {month(d) for d, _ in differ}
    out = []
    for m in {month(d) for d in days} - bad_months:
        n = [sum(c for d, c in s.items() if month(d) == m) for s in sides]
        out.append(("month", m, None, None, "none", *n))
    for d in days - bad_days:
        if month(d) in bad_months:
            out.append(("day", month(d), d, None, "none", sides[0][d], sides[1][d]))
    for d, key in differ:
        a, b = (len(g.get((d, key), [])) for g in groups)
        change = "added" if not a else "removed" if not b else "changed"
        out.append(("key", month(d), d, key, change, a, b))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_located_differences(spark, tmp_path, seed):
    rng = random.Random(seed)
    before = generated(rng, 600)
    after = altered(rng, before)
    rng.shuffle(after)
    trees = [
        ChecksumTree.store(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/{name}", ["id"], "made_at")
        for name, rows in (("before", before), ("after", after))
    ]
    found = locate(*trees)
    expected = by_definition(before, after)
    assert {e[0] for e in expected} == {"month", "day", "key"}
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    names = {e[1].strftime("%Y-%m") if e[1] else "none" for e in expected if e[0] == "key"}
    assert touched_months(*trees) == sorted(names)
    # A tree opened again compares alike; equal states have no difference.
    again = ChecksumTree(spark, f"{tmp_path}/after", ["id"])
    assert locate(again, trees[1]).filter("change <> 'none' OR level <> 'month'").isEmpty()


def test_states_stored_together(spark, tmp_path):
    """As trees stored one by one; also of a state without rows, of repeated and of NULL keys."""
    rng = random.Random(7)
    before = generated(rng, 300) + [(None, 3, 1.0, datetime(2000, 3, 5)), (None, 4, None, None)] * 2
    states = {"earlier": before, "later": altered(rng, before), "none": []}
    frames = {n: spark.createDataFrame(rows, SCHEMA) for n, rows in states.items()}
    trees = ChecksumTree.store_states(frames, f"{tmp_path}/states", ["id"], "made_at")
    for tree, (name, df) in zip(trees, frames.items()):
        alone = ChecksumTree.store(df, f"{tmp_path}/{name}", ["id"], "made_at")
        for level in (lambda t: t.months(), lambda t: t.days(), lambda t: t._keys()):
            rows = [sorted(map(repr, (r.asDict() for r in level(t).collect()))) for t in (tree, alone)]
            assert rows[0] == rows[1]
        direct = df.groupBy("id", F.to_date("made_at").alias("day")).agg(
            *checksums.of_rows(sorted(df.columns))
        )
        stored = tree._keys().select("key_0", "tree_day", *checksums.PARTS)
        assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
    found = locate(trees[0], ChecksumTree(spark, f"{tmp_path}/states", ["id"], "later"))
    assert sorted(map(tuple, found.collect()), key=repr) == by_definition(before, states["later"])
    assert {r["change"] for r in locate(trees[0], trees[2]).collect()} == {"removed"}


def shuffles(df):
    """The shuffles of a plan that are made and those that are used again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    used = plan.count("ReusedExchange")
    # A shuffle that is used again is printed beside its name.
    return plan.count(" Exchange ") + plan.count("-Exchange ") - used, used


def test_rows_are_shuffled_once_as_hashes(spark, settings, tmp_path, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = generated(random.Random(3), 200)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/rows")
    spark.createDataFrame([(r[0], i) for i, r in enumerate(rows)], "id string, more long").write.parquet(f"{tmp_path}/more")
    joined = spark.read.parquet(f"{tmp_path}/rows").join(spark.read.parquet(f"{tmp_path}/more"), "id")
    # A filter on both sides that NULL passes, as that of an earlier state: it stays above the join.
    known = "n + more > 9 OR n + more IS NULL"
    states = {"all": joined, "some": joined.filter(known)}
    written = []
    kind = type(joined)
    sort = kind.sortWithinPartitions
    monkeypatch.setattr(
        kind, "sortWithinPartitions", lambda df, *c: written.append(sort(df, *c)) or written[-1]
    )
    ChecksumTree.store_states(states, f"{tmp_path}/states", ["id"], "made_at")
    # Two sides of the join, made once and used by both states, and one for the hashes.
    assert shuffles(written[0]) == (3, 2)


def test_unchanged_months_are_not_descended(spark, tmp_path):
    rng = random.Random(4)
    before = generated(rng, 500)
    after = altered(rng, before)
    trees = [
        ChecksumTree.store(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/{name}", ["id"], "made_at")
        for name, rows in (("before", before), ("after", after))
    ]
    months = touched_months(*trees)
    read = trees[1].keys(months)
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [tree_month" in scan
    names = read.select(F.input_file_name()).distinct().collect()
    files = {r[0].split("tree_month=")[1].split("/")[0] for r in names}
    assert files == set(months) and len(files) < trees[1].months().count()


def test_empty_and_unlike_trees(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    full = spark.createDataFrame(generated(random.Random(1), 20), SCHEMA)
    none = ChecksumTree.store(empty, f"{tmp_path}/none", ["id"], "made_at")
    some = ChecksumTree.store(full, f"{tmp_path}/some", ["id"], "made_at")
    assert locate(none, none).count() == 0
    assert {r["change"] for r in locate(none, some).collect()} == {"added"}
    assert {r["change"] for r in locate(some, none).collect()} == {"removed"}
    with pytest.raises(ValueError, match="different keys"):
        locate(some, ChecksumTree(spark, f"{tmp_path}/some", ["n"]))
