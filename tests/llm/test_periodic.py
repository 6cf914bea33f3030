import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from compare import difference
from llm_cases import DOCS, LONG, documents

from orderlens.llm import periodic, queries


def by_definition(words, min_length, min_exponent):
    """(start, length, period) of all maximal stretches with their smallest periods."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def generated(rng):
    n, letters = rng.randrange(60), rng.choice([1, 2, 3, 6])
    words = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), 1 + rng.randrange(7)
        words[a:] = [words[min(a + (i - a) % p, n - 1)] for i in range(a, n)]
    return words


def test_runs_by_definition():
    rng = random.Random(1)
    for _ in range(3000):
        words = generated(rng)
        for limits in ((2, 2), (6, 4), (6, 3)):
            found = periodic.runs_of(np.array(words, np.int64), *limits)
            assert [tuple(r) for r in found] == by_definition(words, *limits), (words, limits)


def test_texts_searched_together_do_not_meet():
    rng = random.Random(2)
    for _ in range(100):
        texts = [generated(rng) for _ in range(20)]
        found = periodic.runs_of_all(texts, 6, 4)
        assert [[tuple(r) for r in runs] for runs in found] == [
            by_definition(words, 6, 4) for words in texts
        ]
    assert periodic.runs_of_all([], 6, 4) == []
    assert periodic.runs_of_all([[], [b"a"] * 6, []], 6, 4) == [[], [(0, 6, 1)], []]


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(300):
        words = generated(rng) or [0]
        array = periodic.SuffixArray(np.array(words))
        order = sorted(range(len(words)), key=lambda i: words[i:])
        assert array.order.tolist() == order
        common = [0]
        for a, b in zip(order, order[1:]):
            x, y = words[a:], words[b:]
            common.append(next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y))))
        assert array.common().tolist() == common


def test_no_suffix_is_asked_too_often():
    """Each suffix is in a smaller child at most log n times."""
    words = [i.bit_count() % 2 for i in range(1 << 12)]
    array = periodic.SuffixArray(np.array(words))
    asked = np.zeros(len(words), int)
    for _, _, _, children in periodic.small_children(array.common().tolist(), 2):
        for a, z in children:
            asked[a:z] += 1
    assert asked.max() <= 12


def test_long_periodic_texts():
    once = np.arange(9973)
    assert periodic.runs_of(np.tile(once, 5)) == [(0, 5 * 9973, 9973)]
    assert periodic.runs_of(np.zeros(50_001, int)) == [(0, 50_001, 1)]
    assert periodic.runs_of(np.tile([1, 2, 1, 3], 10_000)[:-1]) == [(0, 39_999, 4)]


def test_strongest_and_collapsed():
    runs = [periodic.Run(0, 8, 2), periodic.Run(9, 4, 1), periodic.Run(20, 9, 2)]
    assert periodic.strongest(runs) == (20, 9, 2)
    assert periodic.strongest(runs[:2]) == (0, 8, 2)
    assert periodic.strongest([]) is None
    # Two runs overlap in the middle word.
    words = list("ababab") + list("bbbbb") + ["c"]
    found = periodic.runs_of_all([words], 4, 3)[0]
    assert [tuple(r) for r in found] == [(0, 6, 2), (5, 6, 1)]
    assert periodic.collapsed(words, found) == ["a", "b", "c"]


def test_exponents_below_two_are_refused():
    with pytest.raises(ValueError, match="two periods"):
        periodic.runs_of(np.zeros(9, int), 1, 1)


def test_frames(spark):
    rows = [*DOCS, (20, "go on " * 7 + "end"), (20, "go on " * 7 + "end"), (21, " x  x x x x x\ty ")]
    docs = documents(spark, rows)
    found = periodic.add_runs(docs, name="n_words").collect()
    assert len(found) == len(rows)
    for row in found:
        words = (row.text or "").encode().split()
        if row.text != LONG:
            assert [tuple(r) for r in row.n_words] == by_definition(words, 6, 4)
    cut = periodic.collapse(docs)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    by_id = {r.doc_id: r.text for r in cut.collect()}
    assert by_id[20] == "go on end" and by_id[21] == "x y"
    assert by_id[0] is None and by_id[2] == " \t\n\x0b\f\r " and by_id[6] == LONG
    assert periodic.add_runs(documents(spark, [])).count() == 0


def planted(key, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(key).encode())
    g = h // 10
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query(spark, folder):
    rng = random.Random(7)
    rows = [(i, t) for i, t in DOCS if t != LONG]
    rows += [(i, " ".join(rng.choice("ab cd e f".split()) for _ in range(i))) for i in range(40, 160)]
    found = queries.queries()["op11_periodic_runs"](spark, folder(documents=documents(spark, rows)))
    expected = []
    for key, text in rows:
        words = planted(key, text)
        runs = by_definition(words, 6, 4)
        top = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = (*top[0], 1000 * top[0][1] // top[0][2]) if top else (None,) * 4
        digests = [hashlib.sha256(b).hexdigest() for b in (lines.encode(), kept)]
        expected.append((key, len(runs), *best, *digests))
    assert sum(e[1] for e in expected) > 20
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_statement(spark):
    from conftest import SMALL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.queries()["op11_periodic_runs"](spark, SMALL)
    assert difference(df, con, queries.oracle_sql()["op11_periodic_runs"]) is None
