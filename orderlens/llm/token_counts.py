"""Token counts by overlapping chunks that are spliced.

A text is never encoded whole if it has more than ``CHUNK`` characters: it is
encoded in chunks with offsets, each of which overlaps the one before. Where both
split the text before the same character into pre-tokens, the count goes over
from one chunk to the next. That place is proven stable: the pattern that splits
the text runs from left to right and looks one character ahead, so a split that
the earlier chunk made, far enough before its end, is a split of the whole text,
and from a split on that both share, the later chunk goes on as the whole text
does. A special token has no split inside; the distance to the chunk's end is at
least the longest special token. If the overlap has no common split, it is
doubled, and the earlier chunk is extended where the overlap has used it up.

All texts go the same way; one of a single chunk has nothing to splice. Chunks of
several texts are handed to the library together. On the generated documents
about four in ten are spliced.

Defined results: null and empty texts have 0 bytes and 0 tokens. A text without
any split, such as one endless word, is encoded whole in the end. A text of any
length is counted in its row, some hundred chunks at a time. Repeated rows and
ids are counted one by one; an empty table gives an empty table; columns other
than key and text are not read, and may have any names.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, islice

from pyspark.sql import DataFrame

from orderlens.llm.arrow import SLICE_CHARS, by_rows, sliced

CHUNK = 2048
OVERLAP = 128
LIMIT = 1024
# Chunks that are handed to the library together.
TOGETHER = 256


def planned(size: int, chunk: int, overlap: int, first: int = 0) -> Iterator[tuple[int, int]]:
    """First and stop of the chunks of a text from ``first`` on if every overlap suffices."""
    while True:
        stop = min(first + chunk, size)
        yield first, stop
        if stop == size:
            return
        first = stop - overlap


class Chunk:
    """An encoded part of a text: its tokens and where pre-tokens start."""

    def __init__(self, coded, first: int, stop: int) -> None:
        self.coded, self.first, self.stop = coded, first, stop
        self.tokens = len(coded)

    def start(self, token: int) -> int:
        """The place in the text where a token starts."""
        return self.first + self.coded.token_to_chars(token)[0]

    def splits(self, stop: int) -> Iterator[tuple[int, int]]:
        """Places up to ``stop`` before which a pre-token but the first starts, and its
        first token. The library is asked token by token: few are looked at."""
        word = self.coded.token_to_word
        for token in range(1, self.tokens):
            if word(token) != word(token - 1):
                place = self.start(token)
                if place > stop:
                    return
                yield place, token

    def split_at(self, place: int) -> int | None:
        """The first token of the pre-token but the first that starts at this place."""
        token = bisect_left(range(self.tokens), place, key=self.start)
        if not 0 < token < self.tokens or self.start(token) != place:
            return None
        word = self.coded.token_to_word
        return token if word(token) != word(token - 1) else None


def spliced_count(
    size: int,
    encode: Callable[[int, int], object],
    margin: int,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> int:
    """Tokens of a text of ``size`` characters, which ``encode`` encodes from place to place.

    ``margin``: a split so close to a chunk's end is not trusted.
    """

    def part(first: int, stop: int) -> Chunk:
        return Chunk(encode(first, stop), first, stop)

    here = part(0, min(chunk, size))
    counted = skipped = 0
    width = overlap
    while here.stop < size:
        first = max(here.stop - width, here.first + 1)
        there = part(first, min(first + max(chunk, 2 * width), size))
        for place, after in there.splits(here.stop - margin):
            before = here.split_at(place)
            if before is not None and before >= skipped:
                break
        else:
            before = None
        if before is not None:
            counted += before - skipped
            here, skipped, width = there, after, overlap
        elif first == here.first + 1:
            here = part(here.first, min(here.stop + max(chunk, here.stop - here.first), size))
            width = overlap
        else:
            width *= 2
    return counted + here.tokens - skipped


class Encodings:
    """Encodes the chunks of one text, the next ones together."""

    def __init__(
        self, text: str, counter: Counter, ready: dict[tuple[int, int], object], ahead: int
    ) -> None:
        self.text, self.counter, self.ready, self.ahead = text, counter, ready, ahead

    def __call__(self, first: int, stop: int):
        coded = self.ready.pop((first, stop), None)
        if coded is None:
            # Chunks left over were made for other places: an overlap was widened.
            self.ahead = 1 if self.ready else min(4 * self.ahead, TOGETHER)
            places = [(first, stop)]
            if stop < len(self.text):
                after = planned(
                    len(self.text), self.counter.chunk, self.counter.overlap,
                    stop - self.counter.overlap,
                )
                places += islice(after, self.ahead - 1)
            made = self.counter.encode([self.text[a:z] for a, z in places])
            self.ready = dict(zip(places, made))
            coded = self.ready.pop((first, stop))
        return coded


@lru_cache(maxsize=2)
def loaded(path: str):
    """The tokenizer of a file, read once per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Counter:
    """Counts tokens with a tokenizer file, as the library does by default."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        if 2 * overlap > chunk:
            raise ValueError("a chunk must be longer than two overlaps")
        self.tokenizer = loaded(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.margin = max([2, *(len(t.content) + 1 for t in added.values())])
        self.chunk, self.overlap = chunk, overlap

    def encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def count(self, texts: list[str]) -> list[int]:
        """The tokens of each text."""
        # The chunks of short texts are encoded together, those of a long one as needed.
        plans = [
            list(planned(len(t), self.chunk, self.overlap)) if len(t) <= SLICE_CHARS else []
            for t in texts
        ]
        parts = [t[a:z] for t, places in zip(texts, plans) for a, z in places]
        coded = chain.from_iterable(
            self.encode(parts[at : at + TOGETHER]) for at in range(0, len(parts), TOGETHER)
        )
        out = []
        for text, places in zip(texts, plans):
            ready = dict(zip(places, islice(coded, len(places))))
            encode = Encodings(text, self, ready, 1 if places else TOGETHER)
            out.append(spliced_count(len(text), encode, self.margin, self.chunk, self.overlap))
        return out


def count(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Key, bytes, tokens and whether there are more than ``limit`` tokens."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        counter = Counter(path, chunk, overlap)

        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for part in sliced(rows, text):
                texts = [r[text] or "" for r in part]
                for row, whole, tokens in zip(part, texts, counter.count(texts)):
                    yield {
                        key: row[key],
                        "n_bytes": len(whole.encode()),
                        "n_tokens": tokens,
                        "over_limit": tokens > limit,
                    }

        return work

    schema = f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return by_rows(docs.select(key, text), make, schema)
