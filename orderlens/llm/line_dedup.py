"""Line dedup by a suffix array over line ids, built by prefix doubling.

A document is the sequence of its lines that have a word. A run is a stretch of
consecutive lines. A line is deleted if it lies in a run of at least
``min_words`` words that also occurs earlier in the corpus, in a document of
smaller id or further up in the same one. The first copy of a run stays.

1. Lines whose id (a 128-bit hash) occurs once are in no repeated run. What is
   left are stretches of shared lines.
2. Suffixes of these stretches are ranked by their first line, then by 2, 4, 8,
   ... lines: the rank of twice the length is the rank of the half plus the
   number of suffixes that share it and whose second half is smaller. As a line
   has a word at least, ranks up to ``min_words`` lines decide everything.
3. Two runs of equal length are equal if their ranks at both ends are: that is
   the interval of suffixes whose common prefix is at least that long. Of every
   interval the first suffix is the original, the others are copies. For each
   line the shortest run from it on and the shortest run up to it that have
   enough words are looked at; they cover exactly all repeated runs.
4. Copies are merged into maximal ranges and cut from the texts.

Ranks are counted from distinct pairs in ranges of ranks, so a line that occurs
in a third of all documents is a few rows and never one task. Only SQL functions
are used.

Defined results: null texts stay null, empty ones empty; a document all of whose
lines go is kept with an empty text; blank lines go where they lie between
deleted lines. Rows with equal id and text are one document and are treated
alike. A null id comes before all others. Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import bind, text_or_empty, words
from orderlens.session import materialize

MIN_WORDS = 50
# Ranges in which the ranks of a group are counted.
RANGES = 1024

DOC = ["d", "h"]
RUN = ["d", "h", "run"]


def _text_hash(text: str) -> Column:
    return F.xxhash64(text_or_empty(text))


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every line with a word: document, number in it, place, words and line id."""
    cut = bind(
        docs.select(F.col(f"`{key}`").alias("d"), F.col(f"`{text}`").alias("text")),
        h=_text_hash("text"),
        lines=F.filter(
            F.transform(
                F.split(text_or_empty("text"), "\n"),
                lambda x, i: F.struct(i.alias("place"), x.alias("line")),
            ),
            lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"),
        ),
    )
    return cut.select(
        *DOC, F.posexplode("lines").alias("i", "x")
    ).select(
        *DOC,
        "i",
        F.col("x.place").alias("place"),
        F.size(words(F.col("x.line"))).alias("words"),
        F.unhex(F.md5(F.col("x.line").cast("binary"))).alias("id"),
    )


def _counted(groups: DataFrame, within: list[str], order: str, total: int) -> DataFrame:
    """Add ``before``: the sum of ``n`` over smaller ``order`` in the same group.

    ``order`` is a number from 0 up to ``total``. Sums are taken in ranges, so
    no group is ordered in one task.
    """
    width = max(1, -(-total // RANGES))
    ranged = groups.withColumn("range", F.floor(F.col(order) / F.lit(width)))
    sums = ranged.groupBy(*within, "range").agg(F.sum("n").alias("size"))
    ahead = Window.partitionBy(*within).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        *within, "range", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("start")
    )
    inside = (
        Window.partitionBy(*within, "range")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.join(starts, [*within, "range"])
        .withColumn(
            "before", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
        )
        .drop("range", "start")
    )


def _shared(lines: DataFrame) -> DataFrame:
    """Lines whose id occurs twice or more, with the stretch they are in and a first rank.

    The first rank orders the ids by their leading bits; equal bits of different
    ids are told apart by counting within the id's range.
    """
    repeated = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = materialize(
        repeated.withColumn("head", F.conv(F.hex(F.substring("id", 1, 4)), 16, 10).cast("long")),
        "line-ids",
    )
    # Ids are ordered by their first four bytes, then whole: the range is the former.
    width = 1 << 20
    ranged = repeated.withColumn("range", F.floor(F.col("head") / F.lit(width)))
    sums = ranged.groupBy("range").agg(F.sum("n").alias("size"))
    # At most 4096 rows.
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("range", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("start"))
    inside = (
        Window.partitionBy("range").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = ranged.join(F.broadcast(starts), "range").select(
        "id", (F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("r0")
    )
    # Rows repeated in the source are one document.
    found = (
        lines.join(ranked, "id")
        .groupBy(*DOC, "i")
        .agg(
            F.any_value("place").alias("place"),
            F.any_value("words").alias("words"),
            F.any_value("r0").alias("r0"),
        )
    )
    order = Window.partitionBy(*DOC).orderBy("i")
    return found.withColumn("run", F.col("i") - F.row_number().over(order))


def _doubled(rows: DataFrame, level: int, total: int) -> DataFrame:
    """Add the rank by the first ``2 ** (level + 1)`` lines."""
    rank = f"r{level}"
    ahead = Window.partitionBy(*RUN).orderBy("i")
    # 0 stands for the end of the stretch.
    paired = rows.withColumn(
        "second", F.coalesce(F.lead(rank, 1 << level).over(ahead) + 1, F.lit(0))
    )
    pairs = paired.groupBy(rank, "second").agg(F.count(F.lit(1)).alias("n"))
    names = _counted(pairs, [rank], "second", total + 1).select(
        rank, "second", (F.col(rank) + F.col("before")).alias(f"r{level + 1}")
    )
    return paired.join(names, [rank, "second"]).drop("second")


def _windows(rows: DataFrame, levels: int, min_words: int) -> DataFrame:
    """The shortest runs with enough words from and up to every line.

    Columns: document, first line, its place, the place of the last line, and
    the name of the run: length and ranks at both ends.
    """
    order = Window.partitionBy(*RUN).orderBy("i")
    before = rows.withColumn("b", F.sum("words").over(order) - F.col("words"))
    ends = before.groupBy(*RUN).agg(
        (F.max("i") + 1).alias("i"), F.max(F.col("b") + F.col("words")).alias("b")
    )
    every = before.unionByName(ends, allowMissingColumns=True)
    # Frames that only grow: each row is added once.
    back = Window.partitionBy(*RUN).orderBy(F.col("b").desc())
    forth = Window.partitionBy(*RUN).orderBy(F.col("b").asc())
    reach = (Window.unboundedPreceding, -min_words)
    placed = every.withColumn("stop", F.min("i").over(back.rangeBetween(*reach))).withColumn(
        "start", F.max("i").over(forth.rangeBetween(*reach))
    )
    runs = placed.groupBy(*RUN).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "i",
                    "place",
                    "stop",
                    "start",
                    F.array(*[F.col(f"r{k}") for k in range(levels + 1)]).alias("r"),
                )
            )
        ).alias("rows")
    )
    rows_, first = F.col("rows"), F.col("rows")[0]["i"]

    def named(start: Column, stop: Column) -> Column:
        length = stop - start
        level = F.floor(F.log2(length.cast("double"))).cast("int")
        last = stop - F.call_function("shiftleft", F.lit(1), level)
        return F.struct(
            start.alias("start"),
            F.get(rows_, start - first)["place"].alias("from"),
            F.get(rows_, stop - 1 - first)["place"].alias("to"),
            length.alias("length"),
            F.get(F.get(rows_, start - first)["r"], level).alias("left"),
            F.get(F.get(rows_, last - first)["r"], level).alias("right"),
        )

    onward = F.transform(
        F.filter(rows_, lambda x: x["stop"].isNotNull()), lambda x: named(x["i"], x["stop"])
    )
    upward = F.transform(
        F.filter(rows_, lambda x: x["start"].isNotNull()), lambda x: named(x["start"], x["i"])
    )
    found = bind(runs, windows=F.concat(onward, upward))
    return found.select(*DOC, F.explode("windows").alias("w")).select(*DOC, "w.*")


def _copies(windows: DataFrame) -> DataFrame:
    """Merged ranges of places to cut from every document."""
    name = ["length", "left", "right"]
    place = F.struct("d", "h", "start")
    firsts = (
        windows.groupBy(*name)
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last")
        .drop("last")
    )
    later = windows.join(firsts, name).filter(place > F.col("first"))
    order = Window.partitionBy(*DOC).orderBy("from", "to")
    reached = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = later.select(*DOC, "from", "to").distinct().withColumn(
        "opens", F.coalesce((F.col("from") > reached + 1).cast("int"), F.lit(1))
    )
    numbered = opened.withColumn("island", F.sum("opens").over(order))
    merged = numbered.groupBy(*DOC, "island").agg(
        F.min("from").alias("from"), F.max("to").alias("to")
    )
    return merged.groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("cuts")
    )


def repeated_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(d, h, cuts): ranges of line places to delete, by id and hash of the text."""
    lines = materialize(_lines(docs, key, text), "lines")
    rows = materialize(_shared(lines), "ranks-0")
    total = rows.count()
    levels = max(0, min_words.bit_length() - 1)
    for level in range(levels):
        rows = materialize(_doubled(rows, level, total), f"ranks-{level + 1}")
    windows = materialize(_windows(rows, levels, min_words), "windows")
    return _copies(windows)


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents without later copies, with ``n_lines``, ``n_cut`` and ``cuts`` added.

    ``n_lines`` and ``n_cut`` count lines, blank ones included.
    """
    cuts = repeated_runs(docs, key, text, min_words).select(
        F.col("d").alias("__d"), F.col("h").alias("__h"), "cuts"
    )
    taken = {"n_lines", "n_cut", "cuts"}
    own = docs.drop(*[c for c in docs.columns if c.lower() in taken])
    joined = own.withColumn("__own_h", _text_hash(text)).join(
        cuts,
        F.col(f"`{key}`").eqNullSafe(F.col("__d")) & (F.col("__own_h") == F.col("__h")),
        "left",
    )
    lines = F.split(F.col(f"`{text}`"), "\n")
    bound = bind(joined.drop("__d", "__h", "__own_h"), __lines=lines)
    ranges, all_lines = F.col("cuts"), F.col("__lines")

    def piece(i: Column) -> Column:
        first = F.coalesce(F.get(ranges, i - 1)["to"] + 1, F.lit(0))
        stop = F.coalesce(F.get(ranges, i)["from"], F.size(all_lines))
        return F.slice(all_lines, first + 1, stop - first)

    rest = F.flatten(F.transform(F.sequence(F.lit(0), F.size(ranges)), piece))
    cut_text = F.when(ranges.isNotNull(), F.array_join(rest, "\n")).otherwise(F.col(f"`{text}`"))
    n_cut = F.aggregate(
        ranges, F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"] + 1
    )
    none = F.array().cast("array<struct<from:int,to:int>>")
    return bound.select(
        *[cut_text.alias(c) if c == text else F.col(f"`{c}`") for c in own.columns],
        F.coalesce(F.size(all_lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(n_cut, F.lit(0)).alias("n_cut"),
        F.coalesce(ranges, none).alias("cuts"),
    )
