import re
from collections import defaultdict

import pytest
from llm_cases import DOCS, documents, rows

from orderlens.llm import quality_rules

COUNTS = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words", "base_failed")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    covered = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return (
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        repeated,
        len(covered),
        n,
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_counts_of_odd_texts(spark):
    judged = quality_rules.judge(documents(spark))
    expected = sorted([(i, *brute(t)) for i, t in DOCS], key=repr)
    assert rows(judged, "doc_id", *COUNTS) == expected
    assert judged.filter("kept and base_failed").count() == 0
    assert {"lang", "source"} < set(judged.columns)


def test_counts_of_generated_texts(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    expected = sorted([(i, *brute(t)) for i, t in texts], key=repr)
    assert rows(quality_rules.judge(df), "doc_id", *COUNTS) == expected


def test_empty_table(spark):
    assert quality_rules.judge(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        " | ".join(f"word{i}" for i in range(80)),
        " ".join(f"word{i}!!" for i in range(80)),
        " ".join(f"word{i}" for i in range(80)),
        "\n".join(["the same line of words"] * 3 + [f"- item {i} the" for i in range(60)]),
    ],
)
def test_junk_is_rejected(spark, text):
    assert rows(quality_rules.judge(documents(spark, [(1, text)])), "kept") == [(False,)]


def test_verdict_follows_the_labels(spark):
    """Nearly all documents labelled good that pass the base rule are kept."""
    folder = "/root/testdata/sf0.01"
    docs = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    labelled = docs.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    passed = labelled.filter("not base_failed")
    good, bad = passed.filter("quality = 1"), passed.filter("quality = 0")
    assert good.filter("kept").count() >= 0.98 * good.count()
    assert bad.filter("kept").count() <= 0.2 * bad.count()
