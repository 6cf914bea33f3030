"""Periodic runs of words by branching tandem repeats in an enhanced suffix array.

A run is a maximal stretch of words with a smallest period q, here at least
``min_exponent`` periods and ``min_length`` words long. Its last square, two
periods up to the end of the run, starts at a word i such that the suffixes at i
and i + q have exactly q words in common: both lie in one interval of the suffix
array whose least common prefix is q, in different children of it. So for every
interval of depth d, each suffix i of all children but the largest asks the
inverse suffix array whether i + d and i - d lie in the interval as well. A
suffix is asked at most log n times, as its interval at least doubles each time.
No tree nodes are kept: a stack over the prefix lengths yields the intervals.

Squares are then rotated to the left as far as the words repeat, which gives the
run, and runs over the same words are merged into the one of least period. A run
of e periods has e words of distance q in the interval, so intervals of fewer
suffixes are passed over.

Ranks by prefix doubling give the suffix array; the ranks of all powers of two
also answer how far two places agree to the right or to the left, for all places
at once.

Texts are taken some at a time. Each has its own numbers for its words, so no
suffix of one agrees with a suffix of another. A longer text is taken alone; the
memory for it is 4 bytes a word for each doubling.

Defined results: null, empty and blank texts have no words and no runs; empty
tables give empty tables; rows are searched one by one, so repeated rows and ids
do not matter; extra columns pass through unless they have the name of a result.
Words are compared whole. Of equal exponents the first run counts, then the one
of shorter period.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from orderlens.llm.arrow import by_rows, kept_fields, with_schema

MIN_LENGTH = 6
MIN_EXPONENT = 4
# Words that are searched together.
BATCH_WORDS = 1 << 16


class Run(NamedTuple):
    start: int
    length: int
    period: int


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, in UTF-8."""
    return (text or "").encode().split()


class SuffixArray:
    """Suffix array of numbers, its inverse, and the ranks of blocks of 2^k numbers.

    Blocks of the largest power are all different, so two places agree for fewer
    numbers than that, and one step for each smaller power finds how many.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable").astype(np.int32)
        rank = np.empty(n, np.int32)
        rank[order] = _group_starts(symbols[order])
        self.order = order
        #: Equal numbers at two places mean equal blocks of 2^k from there.
        self.levels = [rank]
        width = 1
        unsettled = _shared(rank[order])
        while len(unsettled) and width < n:
            # Only groups of equal rank are sorted further, each within its places.
            at = order[unsettled]
            behind = np.where(at + width < n, rank[np.minimum(at + width, n - 1)], -1)
            key = rank[at].astype(np.int64) * (n + 1) + behind + 1
            by_key = np.argsort(key, kind="stable")
            at, key = at[by_key], key[by_key]
            order[unsettled] = at
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.maximum.accumulate(np.where(fresh, unsettled, 0))
            rank = rank.copy()
            rank[at] = first
            width *= 2
            self.levels.append(rank)
            unsettled = unsettled[_shared(first)]
        self.inverse = np.empty(n, np.int32)
        self.inverse[order] = np.arange(n, dtype=np.int32)

    def agree_right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from places ``a`` on equal those from ``b`` on; a <> b."""
        total = np.zeros(len(a), np.int32)
        active = np.arange(len(a))
        for k in range(len(self.levels) - 1, -1, -1):
            level, x, y = self.levels[k], a[active] + total[active], b[active] + total[active]
            inside = np.maximum(x, y) < self.n
            same = np.zeros(len(active), bool)
            same[inside] = level[x[inside]] == level[y[inside]]
            total[active[same]] += 1 << k
        return total

    def agree_left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers before places ``a`` equal those before ``b``; a <> b."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            x, y = a - total - step, b - total - step
            inside = np.flatnonzero(np.minimum(x, y) >= 0)
            total[inside[level[x[inside]] == level[y[inside]]]] += step
        return total

    def common(self) -> np.ndarray:
        """Words that each suffix shares with the one before it in the array."""
        out = np.zeros(self.n, np.int32)
        # Only suffixes with the same first number can share any.
        first = self.levels[0][self.order]
        near = np.flatnonzero(first[1:] == first[:-1]) + 1
        out[near] = self.agree_right(self.order[near - 1], self.order[near])
        return out


def _group_starts(ordered: np.ndarray) -> np.ndarray:
    """The place of the first equal element for each element of a sorted array."""
    places = np.arange(len(ordered), dtype=np.int32)
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else []
    return np.maximum.accumulate(np.where(fresh, places, 0)) if len(ordered) else places


def _shared(ordered: np.ndarray) -> np.ndarray:
    """Places in a sorted array whose element is there more than once."""
    if len(ordered) < 2:
        return np.empty(0, np.int64)
    same = ordered[1:] == ordered[:-1]
    return np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))


def small_children(common: list[int], least: int) -> Iterator[tuple[int, int, int, list]]:
    """(depth, first, last, children but the largest) of the intervals of ``least`` suffixes.

    ``common`` holds the prefix shared with the suffix before; intervals of depth
    0 are left out. Children are ranges of places in the suffix array.
    """
    depths, firsts, borders = [0], [0], [[]]
    for place, depth in enumerate([*common[1:], 0], 1):
        start = place - 1
        while depths[-1] > depth:
            top, start, inner = depths.pop(), firsts.pop(), borders.pop()
            if place - start >= least:
                edges = [start, *inner, place]
                children = list(zip(edges, edges[1:]))
                children.remove(max(children, key=lambda c: c[1] - c[0]))
                yield top, start, place - 1, children
        if depths[-1] < depth:
            depths.append(depth)
            firsts.append(start)
            borders.append([place])
        elif depth:
            borders[-1].append(place)


def runs_of(
    symbols: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[Run]:
    """All runs of a sequence of numbers, by start and period.

    ``min_exponent`` is 2 at least, as a run is found by its last square.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    n = len(symbols)
    if n < min_exponent:
        return []
    suffixes = SuffixArray(symbols)
    found = list(small_children(suffixes.common().tolist(), min_exponent))
    if not found:
        return []
    sides = [(d, lo, hi, a, z) for d, lo, hi, children in found for a, z in children]
    depth, low, high, first, stop = np.array(sides, np.int64).T
    sizes = stop - first
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(owner)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    at, d = suffixes.order[places].astype(np.int64), depth[owner]
    starts, periods = [], []
    for one, two in ((at, at + d), (at - d, at)):
        other = two if one is at else one
        inside = (other >= 0) & (other < n)
        rank = suffixes.inverse[np.where(inside, other, 0)]
        inside &= (low[owner] <= rank) & (rank <= high[owner])
        # In one child both squares halves go on alike: not the last square.
        behind = two + d
        ends = np.where(behind < n, symbols[np.minimum(behind, n - 1)], -1)
        inside &= symbols[np.minimum(two, n - 1)] != ends
        starts.append(one[inside])
        periods.append(d[inside])
    square, period = np.concatenate(starts), np.concatenate(periods)
    end = square + 2 * period
    start = square - suffixes.agree_left(square, square + period)
    length = end - start
    long = (length >= min_length) & (length >= min_exponent * period)
    least: dict[tuple[int, int], int] = {}
    for s, e, p in zip(start[long].tolist(), end[long].tolist(), period[long].tolist()):
        least[s, e] = min(p, least.get((s, e), p))
    return sorted(
        (Run(s, e - s, p) for (s, e), p in least.items()), key=lambda r: (r.start, r.period)
    )


def runs_of_all(texts: list[list], min_length: int, min_exponent: int) -> list[list[Run]]:
    """The runs of each sequence of words, searched together."""
    symbols: list[int] = []
    borders = [0]
    for words in texts:
        own: dict = {}
        base = len(symbols)
        symbols += [own.setdefault(w, base + len(own)) for w in words]
        borders.append(len(symbols))
    out: list[list[Run]] = [[] for _ in texts]
    found = runs_of(np.array(symbols, np.int64), min_length, min_exponent)
    owners = np.searchsorted(borders, [r.start for r in found], side="right") - 1
    for owner, run in zip(owners.tolist(), found):
        out[owner].append(run._replace(start=run.start - borders[owner]))
    return out


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest exponent; of equal ones the first, then of shorter period."""
    return max(
        runs, key=lambda r: (Fraction(r.length, r.period), -r.start, -r.period), default=None
    )


def collapsed(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        edges[run.start + run.period] += 1
        edges[run.start + run.length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def detect(
    docs: DataFrame,
    results: Callable[[list[bytes], list[Run]], dict],
    schema: str,
    text: str = "text",
    words: Callable[[dict], list[bytes]] | None = None,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """Add the columns that ``results`` makes of each text's words and runs.

    ``words`` may give other words for a row than those of its text.
    """
    words = words or (lambda row: words_of(row[text]))
    kept = kept_fields(docs, schema)

    def make():
        def work(rows: Iterator[dict]) -> Iterable[dict]:
            held, texts, size = [], [], 0

            def emit() -> Iterator[dict]:
                found = runs_of_all(texts, min_length, min_exponent)
                for row, own, runs in zip(held, texts, found):
                    yield {name: row[name] for name in kept} | results(own, runs)

            for row in rows:
                own = words(row)
                held.append(row)
                texts.append(own)
                size += len(own)
                if size >= BATCH_WORDS:
                    yield from emit()
                    held, texts, size = [], [], 0
            yield from emit()

        return work

    return by_rows(docs, make, with_schema(docs, schema))


def add_runs(docs: DataFrame, text: str = "text", name: str = "runs") -> DataFrame:
    """Add all runs of every text, places and lengths in words."""

    def results(_: list[bytes], runs: list[Run]) -> dict:
        return {name: [r._asdict() for r in runs]}

    schema = f"`{name}` array<struct<start:bigint,length:bigint,period:bigint>>"
    return detect(docs, results, schema, text)


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with runs cut down to their first period, words joined by a space.

    A text without a run stays as it is.
    """

    def make_words(row: dict) -> list[bytes]:
        return words_of(row[text])

    def results(words: list[bytes], runs: list[Run]) -> dict:
        return {"__collapsed": b" ".join(collapsed(words, runs)).decode() if runs else None}

    from pyspark.sql import functions as F

    found = detect(docs, results, "__collapsed string", text, make_words)
    return found.withColumn(text, F.coalesce("__collapsed", F.col(f"`{text}`"))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
