"""Byte-level byte-pair encoding as a reduction over a tree of halves, and decoding.

The tokens of a byte string are a monoid element: a string is halved down to
leaves of a few bytes, leaves are merged directly, and neighbours are joined up
the tree. A join leaves tokens far from the border as they are. It merges the
bytes of a window around the border anew, one token to each side at first, and
doubles the side on which the window's outermost token and the next token
outside are not stable.

Two tokens are stable side by side if merging their bytes together gives these
two tokens again. That proves the rest: take the first merge that crosses a
border between two tokens of a sequence. Merges before it stayed inside tokens
and came in the order in which they come for the two tokens alone, so the same
merge would cross there, too. A sequence of tokens that are stable side by side
is therefore what merging gives for the whole string. Joining is associative,
as both ways give the one such sequence.

Decoding concatenates the bytes of tokens up a tree of the same kind.

Texts are cut into pieces by the pattern of the vocabulary. Which characters are
letters, digits and white space is asked of the library that defines the result,
as the pattern engine used here may know another version of Unicode.

Pieces, pairs and short strings are kept in tables of bounded size. A full table
is emptied, that of pieces after it was full twice, which changes no result. Defined results: null text is empty text and has no
tokens; empty tables give empty tables; rows are encoded one by one, so repeated
rows and ids do not matter; extra columns pass through unless they have the name
of a result. A text of any length is encoded in one row, its pieces one after
another; memory grows with the text, and one endless piece costs n log² n.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from orderlens.llm.arrow import with_results

# Entries that a table of pieces or pairs may hold, and the longest piece kept.
TABLE_ENTRIES = 400_000
KEPT_CHARS = 64
# Bytes that are merged without being halved, and the longest windows and halves
# of which the tokens are kept: short ones are few and come again.
LEAF_BYTES = 4
KEPT_BYTES = 12
KEPT_HALF = 8
# Tokens whose bytes are concatenated at once.
LEAF_TOKENS = 1 << 12

# A character of each class for the pattern: letter, digit, space, none of them.
# The letter is not one that the pattern names.
CLASSES = {r"\p{L}": "x", r"\p{N}": "0", r"\s": " "}
NO_CLASS = ""


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, which are their ids."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def classes_that_differ() -> dict[int, str]:
    """Stand-ins for the characters whose class the two pattern engines see differently."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    expected, found = {}, {}
    for pattern, stand_in in CLASSES.items():
        probe = tiktoken.Encoding(
            "probe", pat_str=pattern + "+", mergeable_ranks=single, special_tokens={}
        )
        expected |= dict.fromkeys(probe.decode(probe.encode_ordinary(every)), stand_in)
        found |= dict.fromkeys("".join(regex.findall(pattern + "+", every)), stand_in)
    return {
        ord(c): expected.get(c, NO_CLASS)
        for c in expected.keys() | found.keys()
        if expected.get(c) != found.get(c)
    }


def ranges(points: Iterable[int]) -> str:
    """A character set of these code points."""
    out: list[list[int]] = []
    for point in sorted(points):
        if out and out[-1][1] == point - 1:
            out[-1][1] = point
        else:
            out.append([point, point])
    return "[" + "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in out) + "]"


class Pieces:
    """Cuts texts by a pattern, with the character classes of the library."""

    def __init__(self, pattern: str) -> None:
        self.pattern = regex.compile(pattern)
        self.differing = classes_that_differ()
        # Most texts have no character beyond the first differing one, which is found faster.
        least = min(self.differing, default=0x10FFFF)
        self.beyond = re.compile(f"[\\U{least:08x}-\\U0010ffff]")
        self.odd = regex.compile(ranges(self.differing or [0x10FFFF]))

    def cut(self, text: str) -> list[str]:
        if not self.beyond.search(text) or not self.odd.search(text):
            return self.pattern.findall(text)
        seen = text.translate(self.differing)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(seen)]


class TreeEncoder:
    """Tokens of byte strings by joining halves."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, number in ranks.items():
            self.bytes[number] = token
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.merged: dict[bytes, list[int]] = {}

    def merge(self, raw: bytes) -> list[int]:
        """Tokens by merging: the pair of least rank first, of equal ones the leftmost."""
        ids = self.merged.get(raw)
        if ids is None:
            ids = self._merge(raw)
            if len(raw) <= KEPT_BYTES:
                self._keep(raw, ids)
        return ids

    def _keep(self, raw: bytes, ids: list[int]) -> None:
        if len(self.merged) >= TABLE_ENTRIES:
            self.merged.clear()
        self.merged[raw] = ids

    def _merge(self, raw: bytes) -> list[int]:
        rank = self.ranks.get
        n = len(raw)
        stop = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01") * n
        while heap:
            _, at, end = heapq.heappop(heap)
            middle = stop[at]
            # The pair may have changed since it was listed.
            if not alive[at] or middle >= n or stop[middle] != end or not alive[middle]:
                continue
            stop[at] = end
            alive[middle] = 0
            if end < n:
                before[end] = at
                r = rank(raw[at : stop[end]])
                if r is not None:
                    heapq.heappush(heap, (r, at, stop[end]))
            left = before[at]
            if left >= 0:
                r = rank(raw[left:end])
                if r is not None:
                    heapq.heappush(heap, (r, left, end))
        out = []
        at = 0
        while at < n:
            out.append(self.ranks[raw[at : stop[at]]])
            at = stop[at]
        return out

    def stable(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens together gives the two again."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= TABLE_ENTRIES:
                self.pairs.clear()
            known = self.merge(self.bytes[left] + self.bytes[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the bytes of both sequences together."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join([self.bytes[t] for t in left[-i:] + right[:j]]))
            wider_left = i < len(left) and not self.stable(left[-i - 1], window[0])
            wider_right = j < len(right) and not self.stable(window[-1], right[j])
            if not wider_left and not wider_right:
                return left[:-i] + window + right[j:]
            if wider_left:
                i = min(2 * i, len(left))
            if wider_right:
                j = min(2 * j, len(right))

    def encode(self, raw: bytes) -> list[int]:
        """Tokens of a byte string by halves."""
        if len(raw) <= LEAF_BYTES:
            return self.merge(raw)
        ids = self.merged.get(raw)
        if ids is None:
            half = len(raw) // 2
            ids = self.join(self.encode(raw[:half]), self.encode(raw[half:]))
            if len(raw) <= KEPT_HALF:
                self._keep(raw, ids)
        return ids

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """The bytes of the tokens, concatenated up a tree."""
        if len(ids) <= LEAF_TOKENS:
            return b"".join([self.bytes[t] for t in np.asarray(ids).tolist()])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class Tokenizer:
    """Encodes whole texts with the ranks of a file and a pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        self.tree = TreeEncoder(read_ranks(path))
        self.pieces = Pieces(pattern)
        self.known: dict[str, list[int]] = {}
        #: The table before it was full; pieces that come again move over.
        self.older: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        # A piece that is a token is that token, also if no merges lead to it.
        whole = self.tree.ranks.get(raw)
        return [whole] if whole is not None else self.tree.encode(raw)

    def encode(self, text: str) -> np.ndarray:
        pieces = self.pieces.cut(text)
        new = set(pieces).difference(self.known)
        if len(self.known) + len(new) > TABLE_ENTRIES:
            self.older, self.known = self.known, {}
            new = set(pieces)
        known = self.known
        for piece in new:
            known[piece] = self.older.get(piece) or self._piece(piece)
        ids = list(chain.from_iterable(map(known.__getitem__, pieces)))
        for piece in new:
            if len(piece) > KEPT_CHARS:
                del known[piece]
        return np.array(ids, np.uint32)

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        return self.tree.decode(ids)


_LOADED: dict[tuple[str, str], Tokenizer] = {}


def load(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a file, read once per worker."""
    if (path, pattern) not in _LOADED:
        _LOADED.clear()
        _LOADED[path, pattern] = Tokenizer(path, pattern)
    return _LOADED[path, pattern]


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    results: Callable[[Tokenizer, str], dict],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Add the columns that ``results`` makes of the tokenizer and each text."""

    def make():
        tokenizer = load(path, pattern)
        return lambda row: results(tokenizer, row[text] or "")

    return with_results(docs, make, schema)


def token_ids(
    docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids"
) -> DataFrame:
    """Add the token ids of every text as an array."""

    def results(tokenizer: Tokenizer, whole: str) -> dict:
        return {name: tokenizer.encode(whole).tolist()}

    return encode(docs, path, pattern, results, f"`{name}` array<int>", text)


def token_bytes(
    docs: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded"
) -> DataFrame:
    """Add the bytes that every array of ids decodes to; null decodes to none."""

    def make():
        tokenizer = load(path, pattern)
        return lambda row: {name: tokenizer.decode(row[ids] or [])}

    return with_results(docs, make, f"`{name}` binary")
