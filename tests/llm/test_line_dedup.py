import random
import re

import pytest
from llm_cases import DOCS, documents

from orderlens.llm import line_dedup


def brute(data, min_words):
    """{(id, text): (new text, ranges)} by comparing all runs with all earlier ones."""
    docs = sorted({d for d in data}, key=lambda d: (d[0] is not None, d[0] or 0))
    runs, out = {}, {}
    cut = []
    for order, (i, text) in enumerate(docs):
        lines = (text or "").split("\n")
        kept = [(p, x) for p, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        cut.append((lines, kept))
        for a in range(len(kept)):
            total = 0
            for z in range(a, min(len(kept), a + 2 * min_words)):
                total += len(re.findall(r"[^\x20\x09-\x0D]+", kept[z][1]))
                if total >= min_words:
                    name = tuple(x for _, x in kept[a : z + 1])
                    runs.setdefault(name, []).append((order, a, z))
                    if total >= 3 * min_words and z > a + 3:
                        break
    gone = {}
    for places in runs.values():
        for order, a, z in sorted(places)[1:]:
            first, last = cut[order][1][a][0], cut[order][1][z][0]
            gone.setdefault(order, set()).update(range(first, last + 1))
    for order, (i, text) in enumerate(docs):
        deleted = gone.get(order, set())
        lines = cut[order][0]
        rest = "\n".join(x for p, x in enumerate(lines) if p not in deleted)
        out[i, text] = (None if text is None else rest, len(deleted))
    return out


def check(spark, data, min_words):
    found = line_dedup.dedup_lines(documents(spark, data), min_words=min_words)
    expected = brute(data, min_words)
    texts = {}
    rows = found.collect()
    assert len(rows) == len(data)
    for (i, old), (new, n) in expected.items():
        texts.setdefault(i, []).append((new, n))
    seen = {}
    for r in rows:
        seen.setdefault(r.doc_id, set()).add((r.text, r.n_cut))
    assert {i: set(v) for i, v in texts.items()} == seen
    return found


def generated(seed, documents_, vocabulary=12):
    rng = random.Random(seed)
    lines = ["word " * rng.randrange(1, 6) + str(k) for k in range(vocabulary)]
    data = []
    for i in range(documents_):
        body = [rng.choice(lines) for _ in range(rng.randrange(0, 14))]
        for _ in range(rng.randrange(3)):
            body.insert(rng.randrange(len(body) + 1), rng.choice(["", "  ", f"own line {i}"]))
        data.append((i, "\n".join(body)))
    return data


@pytest.mark.parametrize(("seed", "min_words"), [(1, 4), (2, 9), (3, 17)])
def test_random_lines(spark, seed, min_words):
    check(spark, generated(seed, 25), min_words)


def test_odd_texts(spark):
    found = check(spark, DOCS, 4)
    assert {"lang", "source", "kept", "n_words"} < set(found.columns)


def test_copies_and_passages(spark):
    passage = "\n".join(f"line {k} of a passage with some words" for k in range(9)) + "\nend"
    data = [
        (1, "own start\n" + passage + "\nown end"),
        (2, passage),
        (3, "another\n\n" + passage.replace("\n", "\n\n", 2) + "\n\nlast"),
        (4, "short line\nend"),
        (5, "short line\nend"),
        (6, "x\n" + passage + "\ny\n" + passage),
    ]
    found = check(spark, data, 50)
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[1] == data[0][1] and texts[2] == "" and texts[3] == "another\n\n\nlast"
    assert texts[4] == texts[5] == "short line\nend" and texts[6] == "x\ny"


def test_empty_table(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0
