import random
import unicodedata

import public_tokenizers
import pytest
from llm_cases import DOCS, MIXED, documents, rows
from tokenizers import Tokenizer

from orderlens.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counted(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


LONG = [
    MIXED * 60,
    "<|endoftext|>" * 300,
    ("word " * 30 + "<|endoftext|>" + "\n\n   \t x" * 20) * 20,
    " " * 4000 + "x" + " " * 4001,
    "a" * 6000,
    "漢字" * 3000,
    "it's we'll 123 4567 ... !!! " * 300,
    "\n".join(" " * (i % 37) + "line" + "." * (i % 11) for i in range(900)),
]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 4), (200, 16), (1000, 3), (4096, 512)])
def test_spliced_counts(library, texts, chunk, overlap):
    counter = token_counts.Counter(PATH, chunk, overlap)
    data = LONG + [t for _, t in texts[:40]] + [t or "" for _, t in DOCS if t is None or len(t) < 9999]
    if chunk < 200:
        data = [t[:3000] for t in data]
    assert counter.count(data) == [counted(library, t) for t in data]


def test_random_texts(library):
    rng = random.Random(9)
    letters = list("ab c  \n\t'1.!é漢") + ["<|endoftext|>", "<|endof", "'ll", "   "]
    counter = token_counts.Counter(PATH, 40, 2)
    data = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(150)]
    assert counter.count(data) == [counted(library, t) for t in data]


def test_every_character(library):
    """Characters of any version of Unicode count as in the whole text."""
    counter = token_counts.Counter(PATH)
    characters = [
        chr(c)
        for c in range(0x110000)
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")
    ]
    parts = [
        "".join(f"a{c}b {c}1 {c}" for c in characters[i : i + 500])
        for i in range(0, len(characters), 500)
    ]
    assert counter.count(parts) == [counted(library, p) for p in parts]


def test_long_texts_are_encoded_some_chunks_at_a_time(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 1000)
    monkeypatch.setattr(token_counts, "TOGETHER", 7)
    counter = token_counts.Counter(PATH, 60, 20)
    encode, sizes = counter.encode, []
    counter.encode = lambda texts: sizes.append(len(texts)) or encode(texts)
    assert counter.count(LONG) == [counted(library, t) for t in LONG]
    assert max(sizes) == 7


def test_many_documents_are_spliced(texts):
    """Every text goes through the chunks; on the generated ones many have several."""
    whole = [t or "" for _, t in texts]
    counter = token_counts.Counter(PATH)
    encode, lengths = counter.encode, []
    counter.encode = lambda parts: lengths.extend(map(len, parts)) or encode(parts)
    counter.count(whole)
    assert max(lengths) <= token_counts.CHUNK
    # Hardly any chunk is encoded a second time for a wider overlap.
    plans = [list(token_counts.planned(len(t), counter.chunk, counter.overlap)) for t in whole]
    assert len(lengths) <= 1.05 * sum(map(len, plans))
    assert sum(len(p) > 1 for p in plans) >= 0.1 * len(whole)


def test_few_places_are_asked_for(library):
    """Splicing looks at the places of an overlap, never at the offsets of whole chunks."""

    class Coded:
        asked = 0

        def __init__(self, coded):
            self.coded = coded

        def __len__(self):
            return len(self.coded)

        def __getattr__(self, name):
            assert name not in ("offsets", "word_ids")
            Coded.asked += 1
            return getattr(self.coded, name)

    counter = token_counts.Counter(PATH, 64, 16)
    encode, made = counter.encode, []
    counter.encode = lambda parts: made.extend(parts) or [Coded(c) for c in encode(parts)]
    text = "some words of a text that goes on " * 100
    assert counter.count([text]) == [counted(library, text)]
    assert len(made) > 60 and Coded.asked <= 40 * len(made)


def test_one_tokenizer_per_process():
    assert token_counts.Counter(PATH).tokenizer is token_counts.Counter(PATH, 64, 16).tokenizer


def test_chunks_shorter_than_overlaps_are_refused():
    with pytest.raises(ValueError, match="two overlaps"):
        token_counts.Counter(PATH, 10, 6)


def test_frame(spark, library):
    found = token_counts.count(documents(spark), PATH, limit=40, chunk=5000)
    assert rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(
        (
            (i, len((t or "").encode()), counted(library, t or ""), counted(library, t or "") > 40)
            for i, t in DOCS
        ),
        key=repr,
    )
    assert token_counts.count(documents(spark, []), PATH).count() == 0
