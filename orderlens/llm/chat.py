"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered turn by turn as

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>

The three markers are special tokens of the tokenizer, so no token reaches over
the edge of a text. Inside roles and texts a backslash goes between ``<`` and
``|``, and one more where backslashes already stand between them; taking one
away restores the text. The rendered conversation is encoded once with offsets;
the span of every assistant text is found among the sorted token spans by binary
search, and the tokens from the first to the last that it meets bear the loss.

Conversations are sorted by conversation and turn and pass through a task as a
stream. A conversation is written in parts that end with a turn: a marker always
starts a new token, so encoding the parts gives the tokens of the whole. A task
holds one part, never a conversation. Rows of equal turns are ordered by role
and text.

Defined results: null texts and roles are empty; rows without a conversation id
form one conversation; repeated rows are repeated turns; extra columns are not
carried along; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.arrow import by_rows

START, SEP, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PART_CHARS = 1 << 18
LOSS_ROLE = "assistant"

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(STOP), re.S)

PARTS = (
    "formatted string, ids array<int>, token_starts array<int>, token_stops array<int>, "
    "loss array<struct<first:int,stop:int>>"
)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A rendered turn and where its text starts and stops."""
    head = START + escape(role) + SEP
    body = escape(text)
    return head + body + STOP, len(head), len(head) + len(body)


def masked(
    starts: list[int], stops: list[int], spans: list[tuple[int, int]]
) -> list[tuple[int, int]]:
    """Ranges of tokens that meet the spans; all lists are sorted."""
    found = []
    for first, stop in spans:
        low = bisect_right(stops, first)
        high = bisect_left(starts, stop)
        if low < high:
            found.append((low, high))
    return found


class Formatter:
    """Renders and encodes turns with a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.add_special_tokens([START, SEP, STOP])

    def part(self, turns: list[tuple[str, str]]) -> dict:
        """One part of a conversation: text, tokens and token ranges of the loss."""
        pieces, spans, at = [], [], 0
        for role, text in turns:
            piece, first, stop = render(role, text)
            if role == LOSS_ROLE:
                spans.append((at + first, at + stop))
            pieces.append(piece)
            at += len(piece)
        formatted = "".join(pieces)
        coded = self.tokenizer.encode(formatted, add_special_tokens=False)
        starts = [a for a, _ in coded.offsets]
        stops = [b for _, b in coded.offsets]
        return {
            "formatted": formatted,
            "ids": coded.ids,
            "token_starts": starts,
            "token_stops": stops,
            "loss": [{"first": a, "stop": b} for a, b in masked(starts, stops, spans)],
        }


def _ordered(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    rows = turns.select(
        F.col(f"`{key}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "conv").sortWithinPartitions(
        "conv", "turn", "role", "text"
    )


def format_conversations(
    turns: DataFrame,
    path: str,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """The parts of every conversation, in order within their partitions."""
    kind = turns.schema[key].dataType.simpleString()

    def make():
        formatter = Formatter(path)

        def work(rows: Iterator[dict]) -> Iterator[dict]:
            conv, held, size, number, started = None, [], 0, 0, False

            def flush():
                return {key: conv, "part": number, "n_turns": len(held)} | formatter.part(held)

            for row in rows:
                if started and row["conv"] != conv:
                    yield flush()
                    held, size, number = [], 0, 0
                elif size >= part_chars:
                    yield flush()
                    held, size, number = [], 0, number + 1
                conv, started = row["conv"], True
                held.append((row["role"], row["text"]))
                size += len(row["text"]) + len(row["role"])
            if held:
                yield flush()

        return work

    schema = f"`{key}` {kind}, part int, n_turns int, {PARTS}"
    return by_rows(_ordered(turns, key, turn, role, text), make, schema)


def read_back(parts: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation with digests of what its parts say.

    ``parts`` is the result of ``format_conversations`` itself, whose partitions
    hold the parts of a conversation side by side.
    """
    kind = parts.schema[key].dataType.simpleString()

    def make():
        def work(rows: Iterator[dict]) -> Iterator[dict]:
            read = None
            for row in rows:
                if read is None or row["part"] == 0:
                    if read is not None:
                        yield read.result(key)
                    read = _Reader(row[key])
                read.add(row)
            if read is not None:
                yield read.result(key)

        return work

    schema = (
        f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    return by_rows(parts, make, schema)


class _Reader:
    """Digests of one conversation, part by part."""

    def __init__(self, conv) -> None:
        self.conv, self.turns, self.loss_chars, self.formatted = conv, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, row: dict) -> None:
        formatted = row["formatted"]
        self.formatted += len(formatted)
        for role, text in _TURN.findall(formatted):
            self.turns += 1
            self.said.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        for span in row["loss"]:
            first = row["token_starts"][span["first"]]
            stop = row["token_stops"][span["stop"] - 1]
            text = unescape(formatted[first:stop])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def result(self, key: str) -> dict:
        return {
            key: self.conv,
            "n_turns": self.turns,
            "turns_sha256": self.said.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.formatted,
        }
