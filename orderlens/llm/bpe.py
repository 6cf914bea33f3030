"""Byte-pair encoding by backtracking over longest matches, and decoding.

Two neighbouring tokens are compatible if merging the text of both gives these
two tokens again. A sequence of pairwise compatible tokens is the one that the
merges give, so the encoder looks for it directly: an Aho-Corasick automaton
over the vocabulary finds the longest token at every place, the encoder takes
it if it is compatible with the token before, else the next shorter token that
starts there, and steps back where none is left. A place that was given up is
never tried again, so the work is linear in the text. Compatible pairs are kept
in a table.

Decoding and writing ids as decimals gather slices of one byte string through a
table of offsets.

Normalising and cutting into words is done as the file says. Where a text has a
character that the library, which defines the result, may normalise or classify
otherwise than the engines used here, because it knows another version of
Unicode, the library normalises and cuts it. A file with other rules is refused.

Words and pairs are kept in tables of bounded size; a full table is emptied,
which changes no result. Defined results: null text is empty text with no
tokens; empty tables give empty tables; repeated rows are encoded alike; a text
of any length is encoded in its row; other columns pass through.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from orderlens.llm.arrow import by_rows
from orderlens.llm.tree_bpe import ranges

# Entries that a table of words or pairs may hold.
TABLE_ENTRIES = 400_000
# Ids that are gathered at once.
GATHER = 1 << 18
# Marks the end of a word; no byte is written as this character.
END = "\n"
NEVER = float("inf")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class OffsetTable:
    """Byte strings by id, gathered and joined by one space."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.blob = np.frombuffer(b"".join(p + b" " for p in pieces), np.uint8)
        self.lengths = np.array([len(p) + 1 for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def parts(self, ids: np.ndarray) -> Iterator[bytes]:
        """The joined strings of the ids, in parts of bounded size."""
        for at in range(0, len(ids), GATHER):
            part = ids[at : at + GATHER]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1]) + np.repeat(self.starts[part] - (ends - lengths), lengths)
            found = self.blob[places].tobytes()
            yield found if at + GATHER < len(ids) else found[:-1]

    def join(self, ids: np.ndarray) -> bytes:
        return b"".join(self.parts(ids))


class Merges:
    """Merge ranks of a vocabulary, and which tokens may stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        self.rank: dict[tuple[int, int], int] = {}
        self.formed: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made, pair = vocab[left + right], (vocab[left], vocab[right])
            self.rank[pair] = rank
            if made not in self.formed:
                self.formed[made], self.halves[made] = rank, pair
        self.pairs: dict[tuple[int, int], bool] = {}

    def apart(self, left: int, right: int, until: float = NEVER) -> bool:
        """Whether no merge up to rank ``until`` crosses the border of two tokens.

        Before the tokens were whole, parts of them stood at the border: the
        right half of the left token, the left half of the right one, and so
        on. Going back in time, each pair of parts that stood there together
        must not have a merge that comes before one of them was merged away.
        Of equal merges the leftmost is made first.
        """
        left_until = right_until = until
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            left_formed = self.formed.get(left, -1)
            right_formed = self.formed.get(right, -1)
            if left_formed < 0 and right_formed < 0:
                return True
            if left_formed > right_formed:
                left_until, left = left_formed, self.halves[left][1]
            else:
                right_until, right = right_formed, self.halves[right][0]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= TABLE_ENTRIES:
                self.pairs.clear()
            known = self.pairs[left, right] = self.apart(left, right)
        return known

    def reachable(self, token: int) -> bool:
        """Whether merging the token's own text gives the token."""
        work = [token]
        while work:
            whole = work.pop()
            if whole in self.halves:
                left, right = self.halves[whole]
                if not self.apart(left, right, self.formed[whole]):
                    return False
                work += [left, right]
        return True


class WordEncoder:
    """Encodes one word; ``suffix`` is what the vocabulary adds to a word's end."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        self.merges = Merges(vocab, merges)
        bases = set(byte_characters().values())
        self.ids: dict[str, int] = {}
        for token, number in vocab.items():
            ends = bool(suffix) and token.endswith(suffix) and len(token) > len(suffix)
            bare = token.removesuffix(suffix) if ends else token
            plain = bare in bases
            if (plain or number in self.merges.halves) and self.merges.reachable(number):
                self.ids[bare + END if ends else token] = number
        size = max(vocab.values()) + 1
        self.length = [0] * size
        self.shorter: list[int | None] = [None] * size
        self.automaton = ahocorasick.Automaton()
        for token, number in self.ids.items():
            self.length[number] = len(token)
            shorter = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.shorter[number] = next((self.ids[t] for t in shorter if t in self.ids), None)
            if len(token) > 1:
                self.automaton.add_word(token, (number, len(token) - 1))
        self.automaton.make_automaton()
        self.ending = END if suffix else ""

    def longest(self, word: str) -> list[int | None]:
        """The longest token that starts at each place."""
        # Single characters need no search; the automaton has the longer tokens,
        # and of those that start at one place it meets the longest last.
        found = [self.ids.get(c) for c in word]
        for last, (number, before) in self.automaton.iter(word):
            found[last - before] = number
        return found

    def encode(self, word: str) -> list[int]:
        """Token ids of a word in byte characters."""
        word += self.ending
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        found = self.longest(word)
        size = len(word)
        open_at = bytearray(b"\x01") * (size + 1)
        shorter, length = self.shorter, self.length
        known, compatible = self.merges.pairs.get, self.merges.compatible
        ids: list[int] = []
        at, last, token = 0, -1, found[0] if size else None
        while at < size:
            while token is not None:
                end = at + length[token]
                if open_at[end]:
                    fits = True if last < 0 else known((last, token))
                    if fits is None:
                        fits = compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token is not None:
                ids.append(token)
                at, last = end, token
                token = found[at] if at < size else None
            elif ids:
                open_at[at] = 0
                token = ids.pop()
                at -= length[token]
                last = ids[-1] if ids else -1
            else:
                raise ValueError(f"no tokens for {word!r}")
        return ids


# How the file has to normalise and cut texts.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
CUT = {"type": "Split", "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
PLAIN = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
SPECIAL_START = "<|"


def check_rules(spec: dict) -> None:
    """Refuse a file whose rules this module does not follow."""
    cut, as_bytes = spec["pre_tokenizer"].get("pretokenizers", [{}, {}])
    added = spec["added_tokens"]
    rules = {
        "normaliser": spec["normalizer"] == NORMALIZER,
        "word splitting": CUT.items() <= cut.items() and BYTES.items() <= as_bytes.items(),
        "model": spec["model"]["type"] == "BPE" and not any(spec["model"].get(k) for k in PLAIN),
        "special tokens": all(
            t["content"].startswith(SPECIAL_START)
            and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            for t in added
        ),
    }
    wrong = [name for name, right in rules.items() if not right]
    if wrong:
        raise ValueError(f"the file has another {', '.join(wrong)}")


def _normal(text: str) -> str:
    """Composed and lower-cased character by character."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@functools.cache
def odd_characters() -> tuple[int, ...]:
    """Characters that the library normalises or classifies otherwise than this module."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    # The pattern engine knows the newest characters of all; what it does not know,
    # none of the others changes.
    every = map(chr, [*range(0xD800), *range(0xE000, 0x110000)])
    known = "".join(regex.findall(r"[^\p{Cn}\p{Co}]", "".join(every)))
    odd: set[str] = set()
    for pattern in (r"\p{L}+", r"\p{N}+", r"\s+"):
        cut = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        theirs = set("".join(part for part, _ in cut.pre_tokenize_str(known)))
        odd |= theirs.symmetric_difference("".join(regex.findall(pattern, known)))
    lines = known.replace("\n", "")
    # Also beside marks that are put in order with it.
    beside = (("", ""), ("a", "\u0323"), ("a\u0301", ""))
    texts = ["\n".join(a + c + z for c in lines) for a, z in beside]
    compared = [
        (unicodedata.normalize("NFC", t), normalizers.NFC().normalize_str(t)) for t in texts
    ]
    lowered = texts[0].replace("Σ", "σ").lower()
    compared.append((lowered, normalizers.Lowercase().normalize_str(texts[0])))
    for own, theirs in compared:
        pairs = zip(lines, own.split("\n"), theirs.split("\n"))
        odd |= {c for c, one, other in pairs if one != other}
    return tuple(sorted(map(ord, odd)))


class Tokenizer:
    """A lower-casing byte-level tokenizer with word ends, read from its file."""

    def __init__(self, path: str, odd: tuple[int, ...] | None = None) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        check_rules(spec)
        self.path, self.library = path, None
        odd = odd_characters() if odd is None else odd
        # Most texts have no character beyond the first odd one, which is found faster.
        self.beyond = re.compile(f"[\\U{min(odd, default=0x10FFFF):08x}-\\U0010ffff]")
        self.odd = regex.compile(ranges(odd or [0x10FFFF]))
        model = spec["model"]
        self.words = WordEncoder(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        self.table = byte_characters()
        tokens = {number: token for token, number in model["vocab"].items()}
        tokens |= {number: token for token, number in self.special.items()}
        size = max(tokens) + 1
        self.text = OffsetTable([tokens.get(i, "").encode() for i in range(size)])
        self.decimal = OffsetTable([str(i).encode() for i in range(size)])
        self.known: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        if len(self.known) >= TABLE_ENTRIES:
            self.known.clear()
        ids = self.words.encode("".join([self.table[b] for b in word.encode()]))
        if len(word) <= 64:
            self.known[word] = ids
        return ids

    def _cut_by_library(self, part: str) -> list[str]:
        """The words of a text in byte characters."""
        if self.library is None:
            from tokenizers import Tokenizer as Library

            self.library = Library.from_file(self.path)
        normal = self.library.normalizer.normalize_str(part)
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str) -> np.ndarray:
        ids: list[int] = []
        known, special = self.known, self.special
        for part in self.split.split(text) if SPECIAL_START in text else [text]:
            if part in special:
                ids.append(special[part])
                continue
            if self.beyond.search(part) and self.odd.search(part):
                for word in self._cut_by_library(part):
                    ids += self.words.encode(word)
                continue
            for word in self.find(_normal(part)):
                found = known.get(word)
                ids += found if found is not None else self._word(word)
        return np.array(ids, np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of the ids joined by spaces, in UTF-8."""
        return self.text.join(ids)

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimals joined by spaces."""
        return self.decimal.join(ids)


_LOADED: dict[str, Tokenizer] = {}


def load(path: str, odd: tuple[int, ...] | None = None) -> Tokenizer:
    """The tokenizer of a file, read once per worker."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Tokenizer(path, odd)
    return _LOADED[path]


def encode(
    docs: DataFrame,
    path: str,
    results: Callable[[Tokenizer, str], dict],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Encode every text and add the columns ``results`` makes of it.

    ``results`` gets the tokenizer and the text of a row; ``schema`` describes
    the columns it returns, which replace columns of the same names.
    """
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(schema)
    names = {f.name.lower() for f in added.fields}
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    whole = StructType([*kept, *added.fields])
    odd = odd_characters()

    def make():
        tokenizer = load(path, odd)

        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for row in rows:
                made = results(tokenizer, row[text] or "")
                yield {f.name: row[f.name] for f in kept} | made

        return work

    return by_rows(docs, make, _ddl(whole))


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ids_and_digest(tokenizer: Tokenizer, text: str) -> dict:
    """The ids of a text, their number and a digest of what they decode to."""
    ids = tokenizer.encode(text)
    return {
        "n_tokens": len(ids),
        "ids": ids.tolist(),
        "decoded_sha256": hashlib.sha256(tokenizer.decode(ids)).hexdigest(),
    }


def token_ids(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Add the token ids of every text as an array."""

    def results(tokenizer: Tokenizer, whole: str) -> dict:
        return {name: tokenizer.encode(whole).tolist()}

    return encode(docs, path, results, f"`{name}` array<int>", text)


def token_texts(docs: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the decoded text of every array of ids; null decodes to the empty text."""
    from pyspark.sql.types import StringType, StructField, StructType

    kept = [f for f in docs.schema.fields if f.name.lower() != name.lower()]
    whole = StructType([*kept, StructField(name, StringType())])

    odd = odd_characters()

    def make():
        tokenizer = load(path, odd)

        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for row in rows:
                numbers = np.array(row[ids] or [], np.int64)
                yield {f.name: row[f.name] for f in kept} | {
                    name: tokenizer.decode(numbers).decode()
                }

        return work

    return by_rows(docs, make, _ddl(whole))
