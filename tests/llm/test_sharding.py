import struct
import zlib
from collections import Counter
from math import log

import xxhash
from llm_cases import DOCS, documents, rows

from orderlens.llm import sharding


def spark_hash(key, shard):
    seed = 42
    if key is not None:
        seed = xxhash.xxh64(struct.pack("<q", key), seed=seed).intdigest()
    # Spark hashes an int with the 4-byte tail of the same function.
    return xxhash.xxh64(struct.pack("<i", shard), seed=seed).intdigest()


def brute(key, weights):
    costs = []
    for shard, weight in enumerate(weights):
        unit = ((spark_hash(key, shard) >> 11) + 0.5) / (1 << 53)
        costs.append((-log(unit) / weight, shard))
    return min(costs)[1]


def test_plan_matches_brute_force(spark, texts):
    data = texts + [(i, t) for i, t in DOCS]
    placed = sharding.plan(spark.createDataFrame(data, "doc_id long, text string"), [1.0] * 24)
    found = placed.collect()
    expected = sorted(
        (
            repr(i),
            len((t or "").encode()) + 8,
            zlib.crc32((t or "").encode()),
            brute(i, [1.0] * 24),
            brute(i, [1.0] * 25),
        )
        for i, t in data
    )
    assert expected == sorted(
        (repr(r.doc_id), r["size"], r.text_crc32, r["shard"], r.grown_shard) for r in found
    )
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r.grown_shard in (r["shard"], 24) for r in found)


def test_a_hot_key_is_numbered_without_gaps(spark):
    docs = spark.createDataFrame(
        [(7, "same")] * 500 + [(i, str(i)) for i in range(200)], "doc_id long, text string"
    )
    placed = sharding.plan(docs, [1.0] * 3)
    for shard, slots in _slots(placed).items():
        assert sorted(slots) == list(range(len(slots))), shard
    assert placed.count() == 700


def _slots(placed):
    slots = {}
    for r in placed.collect():
        slots.setdefault(r["shard"], []).append(r.slot)
    return slots


def test_weights_share_the_records(spark):
    keys = spark.range(30_000).withColumnRenamed("id", "key")
    counts = Counter(
        r["shard"] for r in sharding.assign(keys, "key", [1.0, 2.0, 3.0]).select("shard").collect()
    )
    assert [round(counts[i] / 5000) for i in range(3)] == [1, 2, 3]


def test_empty_table_and_folders(spark, tmp_path):
    assert sharding.plan(documents(spark, []), [1.0] * 24).count() == 0
    out = str(tmp_path / "shards")
    sharding.write_shards(documents(spark).withColumnRenamed("kept", "shard"), "doc_id", [1.0] * 4, out)
    written = spark.read.parquet(out)
    assert rows(written, "doc_id", "shard") == rows(
        documents(spark).withColumnRenamed("kept", "shard"), "doc_id", "shard"
    )
