"""Quality rules: a threshold table compiled into one projection.

Every rule is a row of ``RULES``: a ratio, its least and its greatest allowed
value. The ratios are built from counts of the text with SQL functions only; no
rows move and nothing is shuffled.

Defined results: a null or empty text has no words, all counts are 0 and it is
rejected by the base rule. Other columns pass through unchanged unless their
name is that of a result, which the result replaces. Rows are judged one by
one, so repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import bind, text_or_empty, words

# Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the languages in the corpus.
STOP_WORDS = {
    "en": "the of and to a in is it that for was on are as with by this be or from an not he at i you".split(),
    "de": "der die das und ein eine in zu den von mit ist im auf des dem nicht sich für als an er es".split(),
    "fr": "le la les de des du un une et en est que qui pour dans par sur pas au il elle ce à".split(),
    "es": "el la los las de del y en un una que es por con para se no al lo su como más".split(),
}


@dataclass(frozen=True)
class Rule:
    """A ratio of counts that has to lie between two values."""

    name: str
    over: str
    under: str
    least: float | None
    most: float | None


# Published heuristics for web text; lines and words as counted below.
RULES = (
    Rule("mean_word_chars", "word_chars", "n_words", 2.0, 16.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.3),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.005, None),
    Rule("exclamation_ratio", "n_exclamations", "n_words", None, 0.5),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 0.5),
)

MIN_WORDS = 50
# Most per cent of the words that may lie in repeated three-word windows.
MOST_REPEATED = 50


def _matches(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(w: Column, hashes: Column) -> Column:
    """Words in three-word windows that occur at least twice in ``w``.

    ``hashes`` has the hash of each window. Where all differ, no window is
    repeated; elsewhere the windows themselves are sorted with their places, so
    equal hashes of different windows change nothing.
    """
    placed = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("gram"),
                i.alias("at"),
            ),
        )
    )

    def covered(p: Column) -> Column:
        found = F.filter(
            p,
            lambda x, i: (x["gram"] == F.get(p, i - 1)["gram"])
            | (x["gram"] == F.get(p, i + 1)["gram"]),
        )
        return F.size(
            F.array_distinct(
                F.flatten(F.transform(found, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))
            )
        )

    # The one-element transform binds the sorted windows, so they are built once.
    bound = F.transform(F.array(placed), covered)
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeats, F.element_at(bound, 1)).otherwise(F.lit(0))


def count(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules and the base condition use."""
    whole = text_or_empty(text)
    stops = sorted({w for group in STOP_WORDS.values() for w in group})
    parts = bind(
        docs,
        __words=words(whole),
        __lines=F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        __symbols=_matches(whole, SYMBOLS),
        __exclamations=_matches(whole, "!"),
    )
    w, lines = F.col("__words"), F.col("__lines")
    grams = F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.col("__symbols"),
        "n_exclamations": F.col("__exclamations"),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(stops))),
        "n_repeat_words": repeated_words(w, F.col("__grams")),
    }
    counted = bind(
        bind(parts, __grams=grams),
        **{name: value.cast("long") for name, value in counts.items()},
    )
    return counted.drop("__words", "__lines", "__symbols", "__exclamations", "__grams")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """One Boolean expression of the whole threshold table."""
    passed = F.lit(True)
    for rule in rules:
        over, under = F.col(rule.over).cast("double"), F.col(rule.under)
        if rule.least is not None:
            passed = passed & (over >= F.lit(rule.least) * under)
        if rule.most is not None:
            passed = passed & (over <= F.lit(rule.most) * under)
    return passed


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    min_words: int = MIN_WORDS,
    most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """Add the counts, ``base_failed`` and ``kept`` to every document."""
    counted = count(docs, text)
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")
    )
    named = counted.drop("base_failed", "kept").withColumn("base_failed", failed)
    return named.withColumn("kept", ~F.col("base_failed") & verdict(rules))
