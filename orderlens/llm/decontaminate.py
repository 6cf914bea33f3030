"""Benchmark decontamination with one Aho-Corasick automaton.

Test items and documents are normalised alike: letters A-Z in lower case, words
of letters, digits and non-ASCII characters, one space between words. Each item
gives its windows of thirteen consecutive words (a shorter item is one window).
The automaton holds all windows, a word to each step, and scans a normalised text
once. Normalising replaces single bytes, so a word's place in the original
follows from its number.

The items are a query set of checked size: their bytes are added up first, and
items are split into blocks of ``BLOCK_BYTES``. An automaton takes about 100 MB
for each megabyte of items, so a block's takes about 200 MB in each worker, where
it is built once. Blocks are read one at a time and sent to each executor once.
Usually there is one block. With more, the documents pass the blocks one after
another, and the hits found so far travel with them in a stored table, of which
only the last is kept; no automaton grows with the benchmark.

Defined results: null and empty texts have no words and no hits; items without
words give no window; a window shared by several items counts for each; a null
item id hits words but is no item in the list; repeated rows are judged alike; an
empty table gives an empty table, an empty benchmark no hits; a text of any
length is scanned whole, in its row. Columns of the documents that are named like
results give way to them; ``clean`` returns the documents' own columns.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.arrow import by_rows
from orderlens.llm.common import text_or_empty
from orderlens.session import discard, materialize

WINDOW = 13
BLOCK_BYTES = 2 << 20
# A document is contaminated if one word in so many is hit.
SHARE = 20

# Bytes that separate words become spaces; A-Z become a-z.
_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

HITS = "array<struct<first:long,stop:long>>"


def _words(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_TABLE).split()


def windows(text: str, window: int = WINDOW) -> set[tuple[bytes, ...]]:
    """The windows of an item as tuples of words."""
    parts = _words(text.encode())
    size = min(window, len(parts))
    return {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)} if parts else set()


class Scanner:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            for found in windows(text, window):
                owners.setdefault(found, set()).update([] if item is None else [item])
        # Words of items are numbered from 1; all other words are 0.
        self.numbers: dict[bytes, int] = {}
        self.owners = [(len(words), tuple(names)) for words, names in owners.items()]
        self.automaton = None
        if owners:
            number = self.numbers
            self.automaton = ahocorasick.Automaton(
                ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE
            )
            for place, words in enumerate(owners):
                key = tuple([number.setdefault(w, len(number) + 1) for w in words])
                self.automaton.add_word(key, place)
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, ranges of hit words and the items found."""
        parts = _words(text.encode())
        if not parts or self.automaton is None:
            return len(parts), [], set()
        number = self.numbers.get
        found = list(self.automaton.iter(tuple([number(w, 0) for w in parts])))
        ranges = [(last + 1 - self.owners[place][0], last + 1) for last, place in found]
        return len(parts), merged(ranges), {n for _, place in found for n in self.owners[place][1]}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open ranges as sorted disjoint ranges."""
    out: list[tuple[int, int]] = []
    for first, stop in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((first, stop))
    return out


def places(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as half-open ranges of code points of the original text."""
    if not ranges:
        return []
    raw = np.frombuffer(text.encode(), np.uint8)
    inside = np.frombuffer(text.encode().lower().translate(_TABLE), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    characters = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts, stops = characters[edges[0::2]], characters[edges[1::2]]
    return [(int(starts[a]), int(stops[b - 1])) for a, b in ranges]


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    return benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"), text_or_empty(text).alias("text")
    ).distinct()


def _block(items: DataFrame, count: int, k: int) -> list[tuple[str | None, str]]:
    """One of so many blocks of the items, which hold about equal bytes."""
    part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
    return [(r.item, r.text) for r in part.collect()]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every document with ``n_words``, ``hits``, ``spans``, ``items`` and ``contaminated``.

    ``hits`` are disjoint ranges of hit words, ``spans`` the same in code points
    of the original text, ``items`` the sorted ids of the items found.
    """
    results = {"n_words", "n_hit", "hits", "spans", "items", "contaminated"}
    kept = [f for f in docs.schema.fields if f.name.lower() not in results]
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = f"{base}, n_words long, hits {HITS}, spans {HITS}, items array<string>"
    items_read = _items(benchmark, item, item_text)
    total = items_read.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    state, before = docs, None
    for k in range(count):
        block = docs.sparkSession.sparkContext.broadcast(_block(items_read, count, k))
        names = [f.name for f in kept]
        state = by_rows(state, _task(block, window, names, text, k > 0), schema)
        if k + 1 < count:
            state = materialize(state, f"decontaminate-{k}")
            if before is not None:
                discard(before)
            before = state
    n_hit = F.aggregate(
        "hits", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["first"]
    )
    return state.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


_BUILT: dict[tuple[str, int], Scanner] = {}


def _scanner(name: str, block: Broadcast, window: int) -> Scanner:
    """The automaton of a block, built once per worker."""
    if (name, window) not in _BUILT:
        _BUILT.clear()
        _BUILT[name, window] = Scanner(block.value, window)
    return _BUILT[name, window]


def _task(block: Broadcast, window: int, kept: list[str], text: str, more: bool):
    name = uuid.uuid4().hex

    def make():
        scanner = _scanner(name, block, window)

        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for row in rows:
                whole = row[text] or ""
                n_words, hits, items = scanner.scan(whole)
                if more:
                    before = [(r["first"], r["stop"]) for r in row["hits"]]
                    hits = merged(hits + before)
                    items |= set(row["items"])
                yield {c: row[c] for c in kept} | {
                    "n_words": n_words,
                    "hits": [{"first": a, "stop": b} for a, b in hits],
                    "spans": [{"first": a, "stop": b} for a, b in places(whole, hits)],
                    "items": sorted(items),
                }

        return work

    return make


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    # Columns named like results are set aside, so that they come out unchanged.
    aside = {c: f"__own_{i}" for i, c in enumerate(docs.columns)}
    text = options.pop("text", "text")
    judged = scan(docs.withColumnsRenamed(aside), benchmark, text=aside[text], **options)
    kept = judged.filter(~F.col("contaminated"))
    return kept.select(*[F.col(name).alias(c) for c, name in aside.items()])
