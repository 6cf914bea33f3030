"""Spelling variants of a vocabulary by a bit-sliced position index.

Two words are near if one inserted, deleted or replaced character makes one of
the other. The index holds, for every position and letter, the set of words with
that letter there, as the bits of one number. A search walks along the searched
word and keeps two sets: the words that agree so far without an error, and those
that agree with one. A step intersects both with the set of the next letter;
what falls out of the first set has its error there and joins the second. For a
missing letter, the second set is compared with the positions shifted by one. All
words of the index advance together, a machine word at a time.

The vocabulary is dealt so that near words meet. With one error in a word of
n letters, the first or the last n // 2 letters are whole, so every word is
indexed under its length with its first half, and under its length with its last
half, and searched under its own length and the next one. A pair that meets
under both halves is taken under the first. A group of more than ``BLOCK`` words
is dealt into blocks of the index, and its searches are copied to each block.
Searches pass a block one by one. Each returns one row: how many words it found
and the best of them. No pairs are stored.

A word's form is its near word of most occurrences, if these are ``ratio`` times
its own. Forms have ever more occurrences, so chains are short; the last form of
a chain, the root, is found by doubling the steps.

Defined results: null and empty texts have no words; empty tables give empty
tables; occurrences in repeated rows and under repeated ids all count; extra
columns are ignored. Of forms with equal counts the first in code-point order is
taken. A text of any length is cut into words in pieces of bounded size. Counts
are merged in tables of bounded size before they are shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.arrow import by_rows
from orderlens.session import materialize

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
# Words of the index in one block.
BLOCK = 1 << 14
# Different words that are counted before they are handed on.
COUNTED = 200_000
# Characters of a text that are searched for words at once.
SEGMENT = 1 << 20

# The letters of a word.
LETTERS = r"A-Za-zÀ-ÿ"


_FIND: dict[int, Callable] = {}
_OTHER = re.compile(f"[^{LETTERS}]")


def word_counts(text: str, least: int = 1) -> Counter:
    """The words of at least so many letters with their number; A-Z in lower case."""
    if least not in _FIND:
        _FIND[least] = re.compile(f"[{LETTERS}]{{{least},}}").findall
    found: Counter = Counter()
    at = 0
    while at < len(text):
        cut = _OTHER.search(text, at + SEGMENT) if at + SEGMENT < len(text) else None
        stop = cut.start() if cut else len(text)
        found.update(_FIND[least](text, at, stop))
        at = stop
    lowered: Counter = Counter()
    for word, n in found.items():
        lowered[word.encode().lower().decode()] += n
    return lowered


def vocabulary(
    docs: DataFrame,
    text: str = "text",
    change: Callable[[dict, str], str] | None = None,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n): words of ``min_letters`` and more that occur ``min_count`` times in all.

    ``change`` gives a word, not longer, to count for a word in a row; a word
    becomes the same at all its places in the row.
    """

    def make():
        def work(rows: Iterator[dict]) -> Iterator[dict]:
            total: Counter = Counter()
            for row in rows:
                for word, n in word_counts(row[text] or "", min_letters).items():
                    counted = change(row, word) if change else word
                    if len(counted) >= min_letters:
                        total[counted] += n
                if len(total) >= COUNTED:
                    yield from ({"word": w, "n": n} for w, n in total.items())
                    total.clear()
            yield from ({"word": w, "n": n} for w, n in total.items())

        return work

    counted = by_rows(docs, make, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Index:
    """Words of one length, as the bits of one number for each position and letter."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.length = len(words[0])
        self.all = (1 << len(words)) - 1
        slices: list[dict[str, int]] = [{} for _ in range(self.length)]
        # Bits are gathered a byte at a time, as numbers do not change in place.
        size = (len(words) + 7) // 8
        for place, by_letter in enumerate(slices):
            bits: dict[str, bytearray] = {}
            for i, word in enumerate(words):
                bits.setdefault(word[place], bytearray(size))[i >> 3] |= 1 << (i & 7)
            by_letter.update((c, int.from_bytes(b, "little")) for c, b in bits.items())
        self.slices = slices

    def replaced(self, word: str) -> int:
        """The words that differ from a word of the same length in one letter."""
        exact, one = self.all, 0
        for letter, by_letter in zip(word, self.slices):
            here = by_letter.get(letter, 0)
            one = (one & here) | (exact & ~here)
            exact &= here
            if not exact and not one:
                return 0
        return one

    def longer(self, word: str) -> int:
        """The words that a letter put into a word, shorter by one, makes."""
        exact, one = self.all, self.all
        # ``one`` has used its extra letter: it compares with the next position.
        for place, letter in enumerate(word):
            one &= self.slices[place + 1].get(letter, 0)
            exact &= self.slices[place].get(letter, 0)
            one |= exact
            if not one:
                return 0
        return one

    def bits(self, found: int) -> Iterator[int]:
        """The places of the words in a set."""
        while found:
            low = found & -found
            yield low.bit_length() - 1
            found ^= low


GROUP = ("side", "length", "half")
# What a row is in its group: a word of the index, or a word that searches it,
# of the same length or shorter by one.
INDEXED, SAME, SHORTER = 0, 1, 2


def _in_groups(words: DataFrame, length: Column, kind: int) -> DataFrame:
    """The words in both groups of the indexed words of this length near them."""
    half = F.floor(length / 2).cast("int")
    sides = [
        F.struct(
            F.lit(side).alias("side"), length.alias("length"), part("word", half).alias("half")
        )
        for side, part in enumerate((F.left, F.right))
    ]
    return words.select("word", "n", F.lit(kind).alias("kind"), F.inline(F.array(*sides)))


def _dealt(words: DataFrame, block: int) -> DataFrame:
    """Indexed words and searches by group and block of the index."""
    size = F.length("word")
    indexed = _in_groups(words, size, INDEXED)
    # Not more than one group for every ``block`` indexed words.
    large = (
        indexed.groupBy(*GROUP)
        .agg(F.count(F.lit(1)).alias("members"))
        .filter(F.col("members") > block)
        .select(*GROUP, F.ceil(F.col("members") / F.lit(block)).cast("int").alias("blocks"))
    )
    searches = _in_groups(words, size, SAME).unionByName(_in_groups(words, size + 1, SHORTER))
    own = F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    return (
        indexed.unionByName(searches)
        .join(large, [*GROUP], "left")
        # In a group of one block the indexed words search it themselves.
        .filter((F.col("kind") != SAME) | F.col("blocks").isNotNull())
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .select(
            "word",
            "n",
            *GROUP,
            "kind",
            (F.col("blocks") > 1).alias("dealt"),
            F.explode(F.when(F.col("kind") == INDEXED, own).otherwise(every)).alias("block"),
        )
    )


class _Block:
    """One block of an index with the searches that come after it."""

    def __init__(self, side: int, words: list[str], counts: list[int]) -> None:
        self.side, self.words, self.counts = side, words, counts
        self.index = Index(words)
        self.half = self.index.length // 2
        self.met: dict[int, tuple[int, int, str]] = {}

    def near(self, word: str, found: int) -> list[int]:
        """The places of found words, without pairs that meet under the first half."""
        if not found:
            return []
        start = word[: self.half]
        return [
            i
            for i in self.index.bits(found)
            if self.side == 0 or self.words[i][: self.half] != start
        ]

    def search(self, word: str, n: int, kind: int) -> Iterator[dict]:
        if kind == SHORTER:
            places = self.near(word, self.index.longer(word))
            # The words found are near to the search, and so is it to them.
            for i in places:
                seen, best_n, best = self.met.get(i, (0, n, word))
                best_n, best = min((-best_n, best), (-n, word))
                self.met[i] = seen + 1, -best_n, best
        else:
            places = self.near(word, self.index.replaced(word))
        if places:
            top = min((-self.counts[i], self.words[i]) for i in places)
            yield {"word": word, "n_near": len(places), "best_n": -top[0], "best": top[1]}

    def met_words(self) -> Iterator[dict]:
        for i, (seen, best_n, best) in self.met.items():
            yield {"word": self.words[i], "n_near": seen, "best_n": best_n, "best": best}


def _search_block(side: int, rows: Iterator[dict]) -> Iterator[dict]:
    """The results of one block: its indexed words come first, then the searches."""
    words, counts, search = [], [], None
    for row in rows:
        if row["kind"] != INDEXED:
            search = row
            break
        words.append(row["word"])
        counts.append(row["n"])
        dealt = row["dealt"]
    if not words or (search is None and (dealt or len(words) == 1)):
        return
    opened = _Block(side, words, counts)
    if not dealt and len(words) > 1:
        for word, n in zip(words, counts):
            yield from opened.search(word, n, SAME)
    if search is not None:
        for row in chain([search], rows):
            yield from opened.search(row["word"], row["n"], row["kind"])
    yield from opened.met_words()


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best): near words found in one group, and the best of them.

    ``words`` has the columns ``word`` and ``n``. A pair is counted in one group.
    """
    dealt = (
        _dealt(words, block)
        .repartition(*GROUP, "block")
        .sortWithinPartitions(*GROUP, "block", "kind", "word")
    )

    def make():
        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for (side, *_), members in groupby(
                rows, key=lambda row: tuple(row[c] for c in (*GROUP, "block"))
            ):
                yield from _search_block(side, members)

        return work

    return by_rows(dealt, make, "word string, n_near long, best_n long, best string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form of the chain from every word that has a form.

    Every round doubles the steps that are taken, and a chain has not more steps
    than the largest count has decimals, so rounds are few.
    """
    links = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(further, "root", "left").select(
            "word",
            F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved"),
        )
        moved = materialize(moved, "forms")
        if moved.filter("moved").isEmpty():
            return links
        links = moved.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Every word with its number of near words, its form and the root of its forms.

    ``words`` has the columns ``word``, each once, and ``n``; it is read several
    times and best stored.
    """
    found = near_words(words, block)
    alone = words.withColumn("n_near", F.lit(0).cast("long"))
    order = F.when(
        F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")
    )
    best = (
        alone.unionByName(found, allowMissingColumns=True)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(order).alias("top"))
    )
    is_form = -F.col("top.less") >= ratio * F.col("n")
    formed = materialize(
        best.select(
            "word",
            "n",
            "n_near",
            F.when(is_form, F.col("top.best")).alias("form"),
            F.when(is_form, -F.col("top.less")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def group_variants(
    docs: DataFrame,
    text: str = "text",
    change: Callable[[dict, str], str] | None = None,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """The words of all texts with their forms and roots."""
    words = materialize(vocabulary(docs, text, change, min_letters, min_count), "vocabulary")
    return variants(words, ratio)
