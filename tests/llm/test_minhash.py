import random
from collections import Counter, defaultdict

import pytest
from llm_cases import DOCS, documents, rows

from orderlens.llm import components, minhash, shingles

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def shingle_tuples(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(data, percent=85):
    """Every pair compared through an inverted index."""
    sets = [shingle_tuples(t) for _, t in data]
    root = {i: i for i, _ in data if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for k, (i, _) in enumerate(data):
        common = Counter()
        if i is not None:
            for s in sets[k]:
                common.update(index[s])
                index[s].append(k)
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[other]) - n):
                a, b = sorted((find(i), find(data[other][0])))
                root[b] = a
    return sorted(
        ((i, len(s), None if i is None else find(i), i is None or find(i) == i)
         for (i, _), s in zip(data, sets)),
        key=repr,
    )


def edited(words, rate, rng):
    return [w if rng.random() > rate else f"new{rng.random()}" for w in words]


def planted():
    """Copies, near copies around the limit, chains, and a large near-copy group."""
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    data, number = [], iter(range(1000, 10_000))
    for rate in (0.0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05):
        for _ in range(6):
            base = fresh(rng.randrange(30, 300))
            for _ in range(3):
                data.append((next(number), " ".join(edited(base, rate, rng))))
    chain = fresh(200)
    for _ in range(12):
        chain = edited(chain, 0.012, rng)
        data.append((next(number), " ".join(chain)))
    base = fresh(150)
    for _ in range(150):
        data.append((next(number), " ".join(edited(base, 0.012, rng))))
    passage = fresh(60)
    for _ in range(80):
        data.append((next(number), " ".join(fresh(40) + passage + fresh(40))))
    rng.shuffle(data)
    return data


def test_planted_and_odd_texts(spark):
    data = planted() + [d for d in DOCS if d[0] != 6] + [(6, "a b c d e f"), (6, "A B  C d e F")]
    found = minhash.near_duplicates(documents(spark, data))
    assert rows(found, *COLUMNS) == brute(data)


def test_generated_texts(spark):
    data = [
        tuple(r)
        for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        .select("doc_id", "text")
        .collect()
    ]
    found = minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    assert rows(found, *COLUMNS) == brute(data)


def test_two_texts_under_one_id_are_one_document(spark):
    texts = [" ".join(f"{k}w{i}" for i in range(20)) for k in "ab"]
    data = [(1, texts[0]), (1, texts[1]), (2, texts[0]), (3, texts[1]), (4, "other words")]
    found = minhash.near_duplicates(documents(spark, data))
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(50))
    data = [(5, text), (3, text + " end"), (9, "x"), (None, text), (7, None)]
    kept = minhash.keep_one(documents(spark, data))
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["3", "7", "9", "None"]
    assert kept.columns == documents(spark, data).columns


@pytest.mark.parametrize("differing", [0, 1, 10, minhash.DISTANCE])
def test_keys_find_all_signatures_within_the_distance(spark, differing):
    rng = random.Random(differing)
    rows_in = []
    for n in range(50):
        one = [rng.randrange(-(2**31), 2**31) for _ in range(shingles.COMPONENTS)]
        two = list(one)
        for k in rng.sample(range(len(two)), differing):
            two[k] ^= 1
        rows_in += [(b"a%d" % n, one), (b"b%d" % n, two)]
    keys = minhash._keys(spark.createDataFrame(rows_in, "digest binary, signature array<int>"))
    pairs = keys.alias("x").join(keys.alias("y"), "key").selectExpr("x.digest a", "y.digest b")
    found = {(bytes(r.a), bytes(r.b)) for r in pairs.distinct().collect()}
    assert all((b"a%d" % n, b"b%d" % n) in found for n in range(50))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 170)] + [(7, i) for i in range(1000, 1400)]
    edges += [(5, 5), (3, 4), (4, 3)]
    random.Random(1).shuffle(edges)
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    expected = {i: 100 for i in range(101, 171)} | {i: 7 for i in range(1000, 1400)} | {4: 3}
    assert {r.node: r.root for r in found.collect()} == expected
