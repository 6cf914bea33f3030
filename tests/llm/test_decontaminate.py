import random
import re

import pytest
from llm_cases import DOCS, documents, rows

from orderlens.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ("doc_id", "n_words", "n_hit", "found", "contaminated")

ITEMS = [
    (1, "what is the capital of france paris"),
    (2, "One two THREE four-five six; seven eight nine ten eleven twelve thirteen fourteen"),
    (10, "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
    (3, None),
    (4, " ... "),
    (None, "no id here"),
    (5, "été ÉTÉ 漢字"),
    (1, "what is the capital of france paris"),
    (6, "a"),
]
TEXTS = [
    (100, "He asked: What is -- the CAPITAL of\nFrance? Paris! Yes. what is the capital of france lyon"),
    (101, "zero " + ITEMS[1][1] + " fifteen sixteen " + ITEMS[2][1]),
    (102, "no id here no id here xno id here"),
    (103, "x été ÉTÉ 漢字 été été 漢字漢字 İÉ"),
    (104, " ".join(["filler"] * 400) + " what is the capital of france paris"),
    (105, "A a b-a ab"),
]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, items, window=13):
    words = [(m[0], m.span()) for m in WORD.finditer(lowered(text))]
    bare = [w for w, _ in words]
    hit, found = set(), set()
    for item, body in items:
        parts = WORD.findall(lowered(body))
        if not parts:
            continue
        size = min(window, len(parts))
        wanted = {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)}
        for i in range(len(bare) - size + 1):
            if tuple(bare[i : i + size]) in wanted:
                hit |= set(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(bare), hit, sorted(found), [words[i][1] for i in sorted(hit)]


def expected(data, items):
    out = []
    for i, text in data:
        n, hit, found, _ = brute(text, items)
        out.append((i, n, len(hit), ",".join(found), bool(hit) and 20 * len(hit) >= n))
    return sorted(out, key=repr)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_odd_texts(spark, block_bytes):
    data = DOCS + TEXTS
    scanned = decontaminate.scan(
        documents(spark, data), bench(spark, ITEMS), block_bytes=block_bytes
    ).selectExpr("*", "array_join(items, ',') AS found")
    assert rows(scanned, *COLUMNS) == expected(data, ITEMS)
    for row in scanned.collect():
        _, _, _, places = brute(row.text, ITEMS)
        covered = {c for s in row.spans for c in range(s["first"], s["stop"])}
        assert {c for a, b in places for c in range(a, b)} <= covered
        for span in row.spans:
            assert WORD.fullmatch(lowered(row.text)[span["first"]])
            assert WORD.fullmatch(lowered(row.text)[span["stop"] - 1])


def test_generated_texts(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    data = [(r.doc_id, r.text) for r in docs.collect()]
    scanned = decontaminate.scan(docs, bench(spark, items)).selectExpr(
        "*", "array_join(items, ',') AS found"
    )
    wanted = expected(data, items)
    assert rows(scanned, *COLUMNS) == wanted


def test_clean_returns_the_documents_columns(spark):
    docs = documents(spark, TEXTS + DOCS).withColumnRenamed("lang", "items")
    cleaned = decontaminate.clean(docs, bench(spark, ITEMS))
    assert cleaned.dtypes == docs.dtypes
    good = []
    for i, text in TEXTS + DOCS:
        n, hit, _, _ = brute(text, ITEMS)
        if not hit or 20 * len(hit) < n:
            good.append((i, text))
    assert rows(cleaned, "doc_id", "text") == sorted(good, key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(documents(spark, []), bench(spark, ITEMS)).count() == 0
    assert decontaminate.scan(documents(spark), none).filter("n_hit > 0").count() == 0


def test_blocks_of_a_larger_benchmark(spark):
    """Items in many blocks; each automaton stays small, and hits of all blocks count."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60)))) for i in range(400)]
    texts = []
    for i in range(60):
        parts = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(parts))
            parts[at:at] = rng.choice(items)[1].split()
        texts.append((i, " ".join(parts)))
    scanned = decontaminate.scan(
        documents(spark, texts), bench(spark, items), block_bytes=20_000
    ).selectExpr("*", "array_join(items, ',') AS found")
    assert rows(scanned, *COLUMNS) == expected(texts, items)


def test_an_automaton_is_built_once_per_worker(monkeypatch):
    built = []
    monkeypatch.setattr(decontaminate, "Scanner", lambda *a: built.append(a) or object())
    monkeypatch.setattr(decontaminate, "_BUILT", {})

    class Sent:
        value = [("1", "a b")]

    one = decontaminate._scanner("x", Sent, 13)
    assert decontaminate._scanner("x", Sent, 13) is one and len(built) == 1
    assert decontaminate._scanner("y", Sent, 13) is not one and len(decontaminate._BUILT) == 1
