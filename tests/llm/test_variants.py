import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from compare import difference
from llm_cases import DOCS, documents, rows

from orderlens.llm import queries, variants

SMALL = "/root/testdata/sf0.001"


def one_error(a, b):
    """Whether one inserted, deleted or replaced character makes one of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def by_definition(counts, ratio=10):
    """(word, form, root, n, n_near, form_n) of every word."""
    forms, near_counts = {}, {}
    for word, n in counts.items():
        near = [v for v in counts if one_error(word, v)]
        near_counts[word] = len(near)
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best and counts[best] >= ratio * n else None
    out = []
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        out.append((word, form, root, n, near_counts[word], counts[form] if form else None))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def misspelt(rng, letters, n, length):
    """Words of which many are near one another, in every way."""
    out = set()
    while len(out) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(length, length + 4)))
        for _ in range(rng.randrange(6)):
            out.add(word)
            at = rng.randrange(len(word))
            word = rng.choice(
                [word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at + rng.randrange(2) :]]
            )
    return sorted(w for w in out if len(w) >= 3)


@pytest.mark.parametrize("block", [variants.BLOCK, 3])
def test_words_by_definition(spark, block):
    """Also with groups dealt into many blocks."""
    rng = random.Random(block)
    words = misspelt(rng, "ab", 150, 5) + misspelt(rng, "aeéstÿ", 250, 7)
    counts = {w: rng.choice([2, 2, 3, 9, 20, 30, 200, 2500]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = variants.variants(frame, block=block)
    assert rows(found, *COLUMNS) == by_definition(counts)


def test_index_by_definition():
    rng = random.Random(4)
    for length in (1, 2, 3, 6, 9):
        words = sorted({"".join(rng.choice("abc") for _ in range(length)) for _ in range(60)})
        index = variants.Index(words)
        for _ in range(60):
            word = "".join(rng.choice("abcd") for _ in range(length))
            same = [words[i] for i in index.bits(index.replaced(word))]
            assert same == [w for w in words if one_error(w, word)]
            word = word[1:]
            longer = [words[i] for i in index.bits(index.longer(word))]
            assert longer == [w for w in words if one_error(w, word)]


def test_chains_of_forms(spark):
    """A root several forms away; equal counts; a form below the ratio."""
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000}
    counts |= {"zzzzzzz": 3, "zzzzzzy": 30, "zzzzzzx": 30, "qqqqqqq": 3, "qqqqqqr": 29}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: r for r in variants.variants(frame).collect()}
    assert {found[w].root for w in list(counts)[:5]} == {"aaabbbb"}
    assert found["zzzzzzz"].form == "zzzzzzx"
    assert found["qqqqqqq"].form is None and found["qqqqqqq"].n_near == 1


def test_words_of_texts(monkeypatch):
    text = "Straße STRASSEN don't ÀÉÎÕÜÿ x×y÷z naïveté2Ärgernis ÆØÅ漢字abcdefg"
    expected = Counter(
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
        for w in re.findall("[A-Za-zÀ-ÿ]+", text)
    )
    assert variants.word_counts(text) == expected
    monkeypatch.setattr(variants, "SEGMENT", 3)
    assert variants.word_counts(text) == expected
    assert variants.word_counts("") == {}


def shortened(key, word):
    h = zlib.crc32(f"{key}:{word}".encode())
    at = h % len(word)
    return word if h % 31 else word[:at] + word[at + 1 :]


def test_query(spark, folder, monkeypatch):
    """Nulls, repeated rows and ids, and long texts all count."""
    monkeypatch.setattr(variants, "COUNTED", 100)
    rng = random.Random(8)
    vocabulary = misspelt(rng, "eioprst", 80, 7)
    texts = [(i, t) for i, t in DOCS if i is not None]
    texts += [
        (i % 50, " ".join(rng.choice(vocabulary[: rng.choice([3, 80])]).title() for _ in range(60)))
        for i in range(100)
    ]
    counts = Counter()
    for key, text in texts:
        for word, n in variants.word_counts(text or "").items():
            counts[shortened(key, word)] += n
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    expected = by_definition(counts)
    assert sum(e[1] is not None for e in expected) > 10
    found = queries.queries()["op12_spelling_variants"](
        spark, folder(documents=documents(spark, [*texts, (None, None)]))
    )
    assert rows(found, *COLUMNS) == expected


def test_empty_tables(spark, folder):
    path = folder(documents=documents(spark, []))
    assert queries.queries()["op12_spelling_variants"](spark, path).count() == 0


def test_statement(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.queries()["op12_spelling_variants"](spark, SMALL)
    assert difference(df, con, queries.oracle_sql()["op12_spelling_variants"]) is None
