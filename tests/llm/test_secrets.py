import hashlib

import pytest
from llm_cases import DOCS, documents, rows

from orderlens.llm import queries, secrets

EXTRA = [
    (20, "pässword Password:'abc123_=' AKIA" + "0" * 15 + " AKIA" + "Q" * 40),
    (21, "secret=abcde secret = abcdef api-key=abcdef apikey=abcdefg \U0001f600 token=\U0001f600x"),
    (22, "-----BEGIN RSA PRIVATE KEY----- gh" + "p_" + "a" * 40 + " eyJabcdefgh.eyJabcdefgh.abcdefgh12"),
    (23, "deadbeef" * 3 + "DEADBEEF" + "deadbeef" * 2 + " sECRET=" + "ab" * 20),
    (24, "token=token=token=abcdef " * 300),
]


def brute(text):
    found = []
    for order, rule in enumerate(secrets.RULES):
        found += [(s, order, rule.kind, e) for s, e in secrets.found_by(rule, text or "")]
    found.sort()
    return [f"{kind}:{s}:{e}" for s, _, kind, e in found]


def expected(i, text):
    spans = brute(text)
    base = [s for s in spans if s.split(":")[0] in ("assign", "access", "hex")]
    return (
        i,
        *[sum(s.startswith(k + ":") for s in spans) for k in ("assign", "access", "hex")],
        hashlib.sha256(",".join(base).encode()).hexdigest(),
        ",".join(spans),
    )


COLUMNS = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def test_spans_match_a_full_scan(spark, texts, folder):
    data = DOCS + EXTRA + texts
    path = folder(documents=documents(spark, data))
    found = queries.queries()["op7_secret_scans"](spark, path)
    assert rows(found, *COLUMNS) == sorted([expected(i, t) for i, t in data], key=repr)


def test_empty_table(spark):
    assert secrets.scan(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("pattern", "query"),
    [
        ("AKIA[A-Z]+", {frozenset({"aki", "kia"})}),
        ("(abcd|xyz)?k", {frozenset()}),
        ("(abcd|xyz)[0-9]+", {frozenset({"abc", "bcd"}), frozenset({"xyz"})}),
        ("ab?c[0-9]*def", {frozenset({"def"})}),
        ("ab[cd]e", {frozenset({"abc", "bce"}), frozenset({"abd", "bde"})}),
        ("(?:abc)+x*(?:def|ghi)", {frozenset({"abc", "def"}), frozenset({"abc", "ghi"})}),
        ("[0-9a-f]{24,}", {frozenset()}),
    ],
)
def test_trigram_queries(pattern, query):
    assert secrets.trigram_query(pattern) == query


def test_candidates_are_few_and_enough(spark, texts):
    rule = secrets.RULES[0]
    query = secrets.trigram_query(rule.pattern)
    trigrams = sorted({t for s in query for t in s})
    docs = documents(spark, texts)
    index = secrets.postings(docs, trigrams, "doc_id", "text")
    found = {r.id for r in secrets.candidates(index, {0: query}).collect()}
    needed = {i for i, t in texts if secrets.found_by(rule, t)}
    assert needed <= found
    assert len(found) < len(texts) / 2
