"""Secret scans with a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams that any
match must contain: a disjunction of sets. The index holds the trigrams the
rules ask for, as rows (trigram, document). A set's postings are intersected by
counting them per document; documents that meet a query are candidates, and
only these run the expression. A rule without mandatory trigrams scans every
text. The index can only offer too many candidates, never too few, so the spans
are those of a full scan.

Postings of a document come from one row, so they are counted before the
shuffle and a frequent trigram is never one group.

Defined results: null text is empty; spans are half-open code point ranges; a
null or repeated document id is handled like any other (candidates of equal ids
are shared, and each text is verified itself); extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import bind, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A pattern whose group ``group`` must have ``least`` characters at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# The patterns of the base kinds, in the order of the kinds.
RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

# Alternatives that are followed letter by letter; beyond that a part is open.
MOST_STRINGS = 64

Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _minimal(query: set[frozenset[str]]) -> Query:
    """Without sets that contain another set of the query."""
    return frozenset(s for s in query if not any(o < s for o in query))


def _both(a: Query, b: Query) -> Query:
    return _minimal({x | y for x, y in product(a, b)})


def _spelled(strings: set[str]) -> Query:
    """What a text must contain if it holds one of these strings."""
    return _minimal(
        {frozenset(s[i : i + 3].lower() for i in range(len(s) - 2)) for s in strings}
    )


def _strings(item: tuple) -> set[str] | None:
    """All strings an element matches, or None if they are too many."""
    op, value = item
    if op is kinds.LITERAL:
        return {chr(value)}
    if op is kinds.IN:
        found: set[str] = set()
        for inner, v in value:
            if inner is kinds.LITERAL:
                found.add(chr(v))
            elif inner is kinds.RANGE and v[1] - v[0] < MOST_STRINGS:
                found |= {chr(c) for c in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is kinds.SUBPATTERN:
        return _sequence(value[3])
    if op is kinds.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op is kinds.MAX_REPEAT and value[1] == 1:
        once = _sequence(value[2])
        return None if once is None else once | ({""} if value[0] == 0 else set())
    return None


def _sequence(items) -> set[str] | None:
    found = {""}
    for item in items:
        part = _strings(item)
        if part is None or len(found) * len(part) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _query(items) -> Query:
    query, run = ANY, {""}
    for item in items:
        part = _strings(item)
        if part is not None and len(run) * len(part) <= MOST_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        query, run = _both(query, _spelled(run)), {""}
        op, value = item
        if part is not None:
            run = part
        elif op is kinds.SUBPATTERN:
            query = _both(query, _query(value[3]))
        elif op is kinds.BRANCH:
            query = _both(query, _minimal({s for b in value[1] for s in _query(b)}))
        elif op is kinds.MAX_REPEAT and value[0] > 0:
            query = _both(query, _query(value[2]))
    return _both(query, _spelled(run))


def trigram_query(pattern: str) -> Query:
    """Sets of lower-case trigrams; every match holds all of at least one set.

    A query with the empty set means that no trigram is mandatory.
    """
    return _query(parser.parse(pattern))


def postings(docs: DataFrame, trigrams: list[str], key: str, text: str) -> DataFrame:
    """The index: a row (trigram, document) for each of these trigrams in a text."""
    lowered = docs.select(F.col(f"`{key}`").alias("id"), F.lower(text_or_empty(text)).alias("low"))
    held = F.filter(
        F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(F.col("low"), t)
    )
    return lowered.select("id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """Per document the rules whose query its postings meet."""
    rows = [
        (rule, part, len(wanted), trigram)
        for rule, query in queries.items()
        for part, wanted in enumerate(sorted(query, key=sorted))
        for trigram in sorted(wanted)
    ]
    # A few rows per rule.
    asked = index.sparkSession.createDataFrame(
        rows, "rule int, part int, wanted long, trigram string"
    )
    met = (
        index.join(F.broadcast(asked), "trigram")
        .groupBy("id", "rule", "part", "wanted")
        .agg(F.count_distinct("trigram").alias("held"))
        .filter("held = wanted")
    )
    return met.groupBy("id").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order, kind, end) of one rule, in code points."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole

    def placed(found: Column, checked: Column, gaps: Column) -> Column:
        none = F.array().cast("array<struct<start:int,rank:int,kind:string,stop:int>>")
        walk = F.aggregate(
            F.sequence(F.lit(0), F.size(found) - 1),
            F.struct(F.lit(0).alias("at"), none.alias("spans")),
            lambda acc, i: F.struct(
                (acc["at"] + F.length(F.get(gaps, i)) + F.length(F.get(found, i))).alias("at"),
                F.when(
                    F.length(F.get(checked, i)) >= rule.least,
                    F.concat(
                        acc["spans"],
                        F.array(
                            F.struct(
                                (acc["at"] + F.length(F.get(gaps, i))).alias("start"),
                                F.lit(order).alias("rank"),
                                F.lit(rule.kind).alias("kind"),
                                (
                                    acc["at"]
                                    + F.length(F.get(gaps, i))
                                    + F.length(F.get(found, i))
                                ).alias("stop"),
                            )
                        ),
                    ),
                )
                .otherwise(acc["spans"])
                .alias("spans"),
            ),
        )
        return F.when(F.size(found) > 0, walk["spans"]).otherwise(none)

    # Bound by one-element arrays, so that every array is made once.
    bound = F.transform(
        F.array(F.struct(whole.alias("m"), part.alias("g"))),
        lambda x: F.element_at(
            F.transform(
                F.array(
                    F.when(
                        F.size(x["m"]) > 0, F.split(text, rule.pattern, -1)
                    ).otherwise(F.array().cast("array<string>"))
                ),
                lambda gaps: placed(x["m"], x["g"], gaps),
            ),
            1,
        ),
    )
    return F.element_at(bound, 1)


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Every document's id, text and the array ``spans`` of all rules' matches."""
    queries = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if frozenset() not in q}
    rows = docs.select(F.col(f"`{key}`"), text_or_empty(text).alias("__text"))
    if indexed:
        trigrams = sorted({t for q in indexed.values() for s in q for t in s})
        found = candidates(postings(docs, trigrams, key, text), indexed)
        rows = rows.join(found, F.col(f"`{key}`").eqNullSafe(F.col("id")), "left").drop("id")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<int>"))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,stop:int>>")
    asked = F.coalesce(F.col("rules"), F.array().cast("array<int>"))
    verified = [
        F.when(F.array_contains(asked, F.lit(i)), _spans(F.col("__text"), rule, i)).otherwise(none)
        if i in indexed
        else _spans(F.col("__text"), rule, i)
        for i, rule in enumerate(rules)
    ]
    placed = bind(rows, spans=F.sort_array(reduce(F.concat, verified)))
    return placed.select(F.col(f"`{key}`"), F.col("__text").alias("text"), "spans")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def found_by(rule: Rule, text: str) -> list[tuple[int, int]]:
    """The spans of one rule in a text by a plain scan, for tests and small texts."""
    return [
        m.span()
        for m in re.finditer(rule.pattern, text, re.ASCII)
        if len(m.group(rule.group)) >= rule.least
    ]
