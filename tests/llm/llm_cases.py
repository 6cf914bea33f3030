"""Small tables with every odd case, shared by the tests of the text operators."""

from __future__ import annotations

LONG = " ".join(f"word{i % 4999}x{i}" for i in range(30_000))
MIXED = (
    "Ärger ÇA İstanbul ﬁ ß ſ K İ̇ é ẞ Σας ΟΔΟΣ 漢字かな交じり文 👩‍👩‍👧  x y\x85z\x1cq "
    "don't I'LL 12٣४ a_b--c...!! <|endoftext|> <|startoftext|>ok <|endoftex"
)

DOCS = [
    (0, None),
    (1, ""),
    (2, " \t\n\x0b\f\r "),
    (3, "one"),
    (4, MIXED),
    (5, "the cat sat on the mat and the cat sat on the mat again\nthe cat\n\nthe cat\n the cat"),
    (6, LONG),
    (6, LONG),
    (7, "a a a a a a a a\nb b\nb b\n...\n- x"),
    (8, 'password="hunter22secret" token: abc\nAPI_KEY = ' + "AKIA" + "Z" * 16 + " pw"),
    (9, "x" * 40 + " " + "0123456789abcdef" * 3 + " passwd=token:abcdefgh AKIAAKIA1234"),
    (None, "a row without an id, secret=abcdef1"),
    (None, None),
    (10, "the and of to " * 20),
    (11, " ".join(f"clean{i}" for i in range(60)) + " the of and"),
]


def documents(spark, rows=None):
    """The rows with extra columns, some named like results."""
    return spark.createDataFrame(
        [(i, t, "en", "s", "x", 7) for i, t in (DOCS if rows is None else rows)],
        "doc_id long, text string, lang string, source string, kept string, n_words int",
    )


def rows(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
