import random

import public_tokenizers
import pytest
import regex
import tiktoken
from llm_cases import DOCS, documents

from orderlens.llm import queries, tree_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own",
        pat_str=PATTERN,
        mergeable_ranks=tree_bpe.read_ranks(PATH),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def own():
    return tree_bpe.Tokenizer(PATH, PATTERN)


def same(own, library, text):
    ids = own.encode(text)
    assert ids.tolist() == library.encode_ordinary(text), text[:80]
    assert own.decode(ids) == library.decode_bytes(ids.tolist())


def test_odd_and_generated_texts(own, library, texts):
    for _, text in DOCS + texts:
        same(own, library, text or "")


def test_every_character(own, library):
    """The library decides which characters are letters, digits or spaces.

    Of characters that no version of Unicode has assigned, some are taken.
    """
    unassigned = regex.compile(r"[\p{Cn}\p{Co}]")
    characters = [
        chr(c)
        for c in range(0x110000)
        if not 0xD800 <= c < 0xE000 and (c % 89 == 0 or not unassigned.match(chr(c)))
    ]
    assert set(own.pieces.differing) <= {ord(c) for c in characters}
    for at in range(0, len(characters), 2000):
        same(own, library, "".join(f"a{c}b {c}1" for c in characters[at : at + 2000]))


def test_endless_pieces(own, library):
    """Borders move through a whole piece, and windows grow to all of it."""
    for text in ("a" * 4099, "ab" * 3000 + "a", "=" * 5001, "\n" * 777, "漢字" * 900, "aaab" * 999):
        same(own, library, text)


def test_random_pieces(own, library):
    rng = random.Random(5)
    for letters in ("ab", "abcdeirstnoul'", " \n\t", "=-_*#", "éß漢字かa"):
        for n in (1, 2, 3, 4, 5, 9, 33, 200):
            for _ in range(20):
                same(own, library, "".join(rng.choice(letters) for _ in range(n)))


def test_small_vocabularies_by_definition():
    """Halves joined at any place give what merging the whole gives."""
    rng = random.Random(6)
    for _ in range(60):
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 290:
            made = rng.choice(tokens[96:99] + tokens[256:]) + rng.choice(tokens[96:99] + tokens[256:])
            if made not in tokens and len(made) < 12:
                tokens.append(made)
        order = list(range(256, 290))
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(tokens[:256])}
        ranks |= {tokens[at]: 256 + i for i, at in enumerate(order)}
        tree = tree_bpe.TreeEncoder(ranks)
        for n in (5, 17, 64):
            raw = bytes(rng.choice(b"`ab") for _ in range(n))
            parts = [raw[i : i + 1] for i in range(n)]
            while True:
                ranked = [
                    (ranks[a + b], i)
                    for i, (a, b) in enumerate(zip(parts, parts[1:]))
                    if a + b in ranks
                ]
                if not ranked:
                    break
                _, i = min(ranked)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            expected = [ranks[p] for p in parts]
            assert tree.merge(raw) == expected
            assert tree.encode(raw) == expected
            for cut in range(n + 1):
                assert tree.join(tree.merge(raw[:cut]), tree.merge(raw[cut:])) == expected
            assert tree.decode(expected) == raw


def test_most_joins_touch_the_border_only(own):
    """A window grows only where tokens move."""
    sizes = []
    merge = own.tree.merge
    own.tree.merge = lambda raw: sizes.append(len(raw)) or merge(raw)
    try:
        own.tree.encode(" ".join(f"word{i * 7919}" for i in range(2000)).encode())
    finally:
        own.tree.merge = merge
    assert max(sizes) < 200


def test_tables_may_be_emptied(library, monkeypatch, texts):
    monkeypatch.setattr(tree_bpe, "TABLE_ENTRIES", 50)
    monkeypatch.setattr(tree_bpe, "LEAF_TOKENS", 7)
    small = tree_bpe.Tokenizer(PATH, PATTERN)
    for _, text in texts[:20]:
        same(small, library, text)


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="no token"):
        tree_bpe.TreeEncoder({b"a": 0, b"b": 1})


def test_frames(spark, library):
    docs = documents(spark)
    coded = tree_bpe.token_ids(docs, PATH, PATTERN, name="kept")
    assert set(coded.columns) == set(docs.columns)
    back = tree_bpe.token_bytes(coded, PATH, PATTERN, ids="kept", name="n_words").collect()
    assert len(back) == len(DOCS)
    for row in back:
        assert row.kept == library.encode_ordinary(row.text or "")
        assert bytes(row.n_words) == (row.text or "").encode()
    assert tree_bpe.token_ids(documents(spark, []), PATH, PATTERN).count() == 0
    none = docs.selectExpr("CAST(NULL AS ARRAY<INT>) AS ids")
    assert tree_bpe.token_bytes(none, PATH, PATTERN).first().decoded == b""


def test_query(spark, folder, library):
    import hashlib
    import struct

    path = folder(documents=documents(spark))
    found = queries.queries()["op13_byte_bpe"](spark, path)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = []
    for key, text in DOCS:
        ids = library.encode_ordinary(text or "")
        packed = b"".join(struct.pack("<I", i) for i in ids)
        digests = [hashlib.sha256(b).hexdigest() for b in (packed, (text or "").encode())]
        expected.append((key, len(ids), *digests))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
