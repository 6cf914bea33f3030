import json
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import DOCS, documents
from tokenizers import Tokenizer

from orderlens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(PATH)


def same(own, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    found = own.encode(text)
    assert found.tolist() == expected, text[:80]
    assert own.decode(found).decode() == library.decode(expected, skip_special_tokens=False)
    assert own.decimals(found).decode() == " ".join(map(str, expected))


def test_odd_and_generated_texts(own, library, texts):
    for _, text in DOCS + texts:
        same(own, library, text or "")


def test_random_words(own, library):
    rng = random.Random(3)
    letters = "abcdeirstnoul" * 3 + "kxyzq'é漢ßаб0123 "
    for _ in range(400):
        same(own, library, "".join(rng.choice(letters) for _ in range(rng.randrange(60))))
    same(own, library, "ab" * 5000 + "a" * 3001 + "the" * 700)


def test_every_character(own, library):
    """Every character between letters, a block at a time."""
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(characters), 2000):
        same(own, library, "".join(f"a{c}b {c}1" for c in characters[at : at + 2000]))


def test_odd_characters_beside_marks(own, library):
    """Texts with characters of newer versions of Unicode, in any order."""
    rng = random.Random(5)
    odd = [chr(c) for c in bpe.odd_characters()]
    marks = "\u0301\u0323\u0345\u1dce\u0e48"
    for _ in range(300):
        text = "".join(
            rng.choice((rng.choice(odd), rng.choice(marks), rng.choice("aZß. 1Σ\n<|")))
            for _ in range(40)
        )
        same(own, library, text + "<|endoftext|>")


@pytest.mark.parametrize(
    "change",
    [
        lambda d: d["normalizer"]["normalizers"].pop(),
        lambda d: d.update(normalizer=None),
        lambda d: d["pre_tokenizer"]["pretokenizers"][0].update(invert=False),
        lambda d: d["added_tokens"][0].update(content="[start]"),
        lambda d: d["added_tokens"][0].update(lstrip=True),
        lambda d: d["model"].update(byte_fallback=True),
    ],
)
def test_files_with_other_rules_are_refused(tmp_path, change):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    change(spec)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="the file has another"):
        bpe.Tokenizer(str(path))


def test_pairs_by_definition(own):
    """A pair is compatible if merging both texts gives the pair."""
    merges = own.words.merges
    tokens = {n: t for t, n in own.words.ids.items()}
    by_pair = {pair: made for made, pair in merges.halves.items()}

    def merged(text):
        parts = [own.words.ids[c] for c in text.removesuffix(bpe.END)]
        if text.endswith(bpe.END):
            parts[-1] = own.words.ids[text[-2:]]
        while True:
            ranked = [
                (merges.rank[p], i)
                for i, p in enumerate(zip(parts, parts[1:]))
                if p in merges.rank
            ]
            if not ranked:
                return parts
            _, i = min(ranked)
            parts[i : i + 2] = [by_pair[parts[i], parts[i + 1]]]

    rng = random.Random(4)
    inner = [n for n, t in tokens.items() if not t.endswith(bpe.END)]
    for _ in range(3000):
        left, right = rng.choice(inner), rng.choice(list(tokens))
        assert merges.compatible(left, right) == (
            merged(tokens[left] + tokens[right]) == [left, right]
        )


def test_tables_may_be_emptied(library, monkeypatch, texts):
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 50)
    small = bpe.Tokenizer(PATH)
    for _, text in texts[:20]:
        same(small, library, text)


def test_frames(spark, library):
    docs = documents(spark)
    coded = bpe.token_ids(docs, PATH, name="kept")
    assert set(coded.columns) == set(docs.columns)
    back = bpe.token_texts(coded, PATH, ids="kept", name="n_words").collect()
    assert len(back) == len(DOCS)
    for row in back:
        expected = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.kept == expected
        assert row.n_words == library.decode(expected, skip_special_tokens=False)
    assert bpe.token_ids(documents(spark, []), PATH).count() == 0


def test_long_decodes_are_gathered_in_parts(own):
    ids = np.arange(bpe.GATHER * 2 + 5) % 4000
    assert own.decimals(ids).decode() == " ".join(map(str, ids))
    assert own.decimals(ids[:0]) == b""
