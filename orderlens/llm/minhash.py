"""Near duplicates by min-hash signatures and a multi-index Hamming join.

A document's set are its distinct five-word shingles. Documents with equal sets
form a class, and only one row per class goes on. A signature has 42 min-hash
components of 32 bits, cut into 7 chunks of 6. Two signatures that differ in at
most 13 components agree in some chunk up to one component (pigeonhole), so every
class is listed under 42 keys: each chunk with each of its components left out.
Classes that share a key are candidates; all pairs within the distance of 13
share one. Pairs beyond it that share a key are candidates as well, up to a
distance of 18. A pair of similarity 0.85 shares no key with probability 3e-5,
one of 0.8 with 6e-4, and unlike texts hardly ever do: a pair of 0.5 shares one
key on average.

First every key links its members to one leader. Links are confirmed on the full
sets, and components are built. After that only members of one key in different
components are of interest. A shingle that no other set in question has cannot
be common; a set with too many of them is linked with nothing and goes.

Members of a key of more than ``HOT`` are dealt further by an exact bound. The
shingles of a set are ordered by how many sets have them, rarest first. Two sets
of similarity t share one of the first n - ceil(t n) + 1 shingles, so the members
of such keys meet under these shingles instead, with their places: what follows
the place in the smaller rest must suffice for the similarity. A passage that
many texts share is last in the order and brings none of them together.

Then every member outside the largest component of its group is compared with
one member of that component (``PROBES`` times, each time with another one); most
members that belong to it are found so, for one pair each. After that a round
takes some members of each group that are outside its largest component, compares
them with the members of other components, and drops them: ``LEADERS`` at first,
which is all of them in most groups, then ``GROWTH`` times as many in every round.
A group is done when what remains is one component, so no link that could change
a component is lost.

Sets are compared in blocks of a leader's members, so a hot leader is many
groups. All state between rounds is in stored tables, which are removed when the
next round has written its own.

Defined results: null and empty texts have no shingles, are linked with nothing
and are kept; an empty table gives an empty table. A text of fewer words than a
shingle is one shingle. A very long text is one set, held by one task at a time.
A row without id is linked with nothing, has no component and is kept. Rows that
share an id are one document; texts under one id are linked. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import shingles
from orderlens.llm.arrow import by_rows
from orderlens.llm.components import components
from orderlens.session import discard, materialize

PERCENT = 85
CHUNK = 6
CHUNKS = shingles.COMPONENTS // CHUNK
# Differing components that the keys are guaranteed to find: one for each chunk
# may be left out, so a pair is missed only with two in every chunk.
DISTANCE = 2 * CHUNKS - 1
# Differing components of candidates whose sets are compared.
COMPARED = 18
# Members of a key that are dealt by their shingles.
HOT = 64
PROBES = 1
LEADERS = 256
GROWTH = 4
# Members that are compared with a leader in one group.
BLOCK = 512


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, number of shingles, digest of the set and signature of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def work(rows: Iterator[dict]) -> Iterator[dict]:
            for row in rows:
                found = shingles.shingle_set(row[text])
                some = len(found) > 0
                yield {
                    "id": row[key],
                    "n_shingles": len(found),
                    "digest": shingles.digest(found) if some else None,
                    "signature": shingles.signature(found).tolist() if some else None,
                }

        return work

    schema = f"id {kind}, n_shingles long, digest binary, signature array<int>"
    return by_rows(docs.select(key, text), make, schema)


def _keys(classes: DataFrame) -> DataFrame:
    """Every class under the key of each chunk with one component left out."""
    found = [
        F.xxhash64(
            F.lit(chunk),
            F.lit(left_out),
            *[
                F.col("signature")[chunk * CHUNK + k]
                for k in range(CHUNK)
                if k != left_out
            ],
        )
        for chunk in range(CHUNKS)
        for left_out in range(CHUNK)
    ]
    return classes.select("digest", F.explode(F.array(*found)).alias("key"))


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """The full sets and signatures of these classes, from the text of one document of each."""
    rows = docs.select(F.col(f"`{key}`").alias("rep"), F.col(f"`{text}`").alias("text"))

    def make():
        def work(found: Iterator[dict]) -> Iterator[dict]:
            for row in found:
                own = shingles.shingle_set(row["text"])
                # Another text under the same id has another digest.
                if len(own) and shingles.digest(own) == row["digest"]:
                    yield {
                        "digest": row["digest"],
                        "members": own.tobytes(),
                        "signed": shingles.signature(own).tobytes(),
                    }

        return work

    schema = "digest binary, members binary, signed binary"
    return by_rows(rows.join(wanted, "rep"), make, schema)


class _Finder:
    """Confirms candidate pairs of one run."""

    def __init__(self, known: DataFrame, sets: DataFrame, percent: int) -> None:
        self.known, self.sets, self.percent = known, sets, percent

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose signatures are within the distance."""
        one = self.known.select(F.col("digest").alias("a"), F.col("signature").alias("one"))
        two = self.known.select(F.col("digest").alias("b"), F.col("signature").alias("two"))
        apart = F.aggregate(
            F.zip_with("one", "two", lambda x, y: (x != y).cast("int")),
            F.lit(0),
            lambda n, x: n + x,
        )
        return pairs.join(one, "a").join(two, "b").filter(apart <= COMPARED).select("a", "b")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) within the distance whose sets are similar enough; ``a`` leads."""
        counts = pairs.groupBy("a").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks")
        )
        members = pairs.join(counts, "a").select(
            "a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "b"
        )
        heads = counts.select(
            "a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        ).withColumn("b", F.col("a"))
        # Rows repeated in the source have their set, and so a link, several times.
        rows = (
            members.unionByName(heads)
            .join(self.sets.withColumnRenamed("digest", "b"), "b")
            .select("a", "block", "b", "members", "signed")
        )
        partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.repartition(partitions, "a", "block").sortWithinPartitions(
            "a", "block", F.col("a") != F.col("b")
        )
        percent = self.percent

        def make():
            def work(found: Iterator[dict]) -> Iterator[dict]:
                group = head = sign = None
                for row in found:
                    own = np.frombuffer(row["members"], np.uint64)
                    signed = np.frombuffer(row["signed"], np.int32)
                    if (row["a"], row["block"]) != group:
                        group, head, sign = (row["a"], row["block"]), own, signed
                    elif (
                        row["a"] != row["b"]
                        and np.count_nonzero(sign != signed) <= COMPARED
                        and shingles.linked(head, own, percent)
                    ):
                        yield {"a": row["a"], "b": row["b"]}

            return work

        return by_rows(dealt, make, "a binary, b binary")


def _rooted(state: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of every key with their component so far."""
    named = roots.select(F.col("node").alias("digest"), "root")
    return state.join(named, "digest", "left").withColumn("root", F.coalesce("root", "digest"))


def _unfinished(state: DataFrame) -> DataFrame:
    """Members of keys with several components, the largest component of the key, and how
    many members are outside it."""
    sizes = state.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    open_keys = (
        sizes.groupBy("key")
        .agg(
            F.max(F.struct("size", "root")).alias("top"),
            F.count(F.lit(1)).alias("parts"),
            F.sum("size").alias("members"),
        )
        .filter("parts > 1")
        .select(
            "key",
            F.col("top.root").alias("largest"),
            (F.col("members") - F.col("top.size")).alias("outside"),
        )
    )
    return state.join(open_keys, "key")


def _spread(sets: DataFrame, state: DataFrame) -> DataFrame:
    """(shingle, digest) of the sets that may still be linked."""
    import pyarrow as pa

    wanted = sets.join(state.select("digest").distinct(), "digest", "left_semi")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, members in zip(batch.column("digest"), batch.column("members")):
                own = np.frombuffer(members.as_py(), np.int64)
                for at in range(0, len(own), 1 << 16):
                    part = own[at : at + (1 << 16)]
                    names = pa.array([digest.as_py()], pa.binary()).take(
                        pa.array(np.zeros(len(part), np.int64))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), names], names=["shingle", "digest"]
                    )

    return wanted.select("digest", "members").mapInArrow(spread, "shingle long, digest binary")


def _shareable(sets: DataFrame, state: DataFrame) -> DataFrame:
    """(digest, n, s): size of a set and how many of its shingles another set has.

    Only sets still in ``state`` count, as only those can be linked any more.
    """
    alone = (
        _spread(sets, state)
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("sets"), F.min("digest").alias("digest"))
        .filter("sets = 1")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    wanted = sets.join(state.select("digest").distinct(), "digest", "left_semi")
    sizes = wanted.groupBy("digest").agg(
        F.max(F.octet_length("members") / 8).cast("long").alias("n")
    )
    return sizes.join(alone, "digest", "left").select(
        "digest", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s")
    )


def _linkable(state: DataFrame, percent: int) -> DataFrame:
    """Members that may still be linked with some member of their key.

    Two sets have at most the smaller ``s`` in common, which bounds their
    similarity. The shortest set of a key is the best partner a set can have.
    """
    shortest = state.groupBy("key").agg(F.min("n").alias("shortest"))
    possible = F.col("s") * (100 + percent) >= percent * (F.col("n") + F.col("shortest"))
    return (
        state.join(shortest, "key")
        .filter((100 * F.col("s") >= percent * F.col("n")) & possible)
        .drop("shortest")
    )


def _prefixes(sets: DataFrame, state: DataFrame, percent: int) -> DataFrame:
    """(key, digest, n, s, place): the shingles of a set under which it meets others.

    ``place`` counts from 1 in the order of the set's shingles, those that no
    other of these sets has first. Only shingles that others have are listed.
    """
    members = state.select("digest", "n").distinct()
    spread = _spread(sets, members)
    shared = (
        spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    )
    # Sets have as many shingles at most as a text has words.
    own = Window.partitionBy("digest")
    by_rarity = own.orderBy("sets", "shingle")
    least = F.ceil(F.col("n") * percent / 100).cast("long")
    placed = (
        spread.join(shared, "shingle")
        .join(members, "digest")
        .withColumn("s", F.count(F.lit(1)).over(own))
        .withColumn("place", F.col("n") - F.col("s") + F.row_number().over(by_rarity))
    )
    return placed.filter(F.col("place") <= F.col("n") - least + 1).select(
        F.xxhash64(F.lit("shingle"), "shingle").alias("key"), "digest", "n", "s", "place"
    )


def _named(first: Column) -> list[Column]:
    """A member as one side of pairs."""
    names = {"digest": "a", "root": "root_a", "n": "n_a", "s": "s_a", "place": "place_a"}
    return [first[name].alias(alias) for name, alias in names.items()]


MEMBER = ("digest", "root", "n", "s", "place")


def _representatives(active: DataFrame, probe: int) -> DataFrame:
    """One member of the largest component of every group, another one for each probe."""
    chance = F.xxhash64(F.lit(probe), "key", "digest")
    return (
        active.filter("root = largest")
        .groupBy("key")
        .agg(F.min(F.struct(chance.alias("chance"), *MEMBER)).alias("first"))
        .select("key", *_named(F.col("first")))
    )


def _leaders(active: DataFrame, slots: int) -> DataFrame:
    """This round's leaders of every unfinished key, one for each slot.

    Where there are slots for all, each has its own.
    """
    chance = F.xxhash64("digest")
    slot = F.when(F.col("outside") <= slots, chance).otherwise(F.pmod(chance, F.lit(slots)))
    return (
        active.filter("root <> largest")
        .groupBy("key", slot.alias("slot"))
        .agg(F.min(F.struct(*MEMBER)).alias("first"))
        .select("key", *_named(F.col("first")))
    )


def _dealt(state: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members by key, those of hot keys by the shingles under which they meet."""
    hot = state.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter(
        F.col("members") > HOT
    )
    small = state.join(hot, "key", "left_anti").withColumn("place", F.lit(1).cast("long"))
    large = state.join(hot, "key", "left_semi")
    return small.select("key", "digest", "n", "s", "place").unionByName(
        _prefixes(sets, large, percent)
    )


def links(
    docs: DataFrame,
    classes: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """(node, root) for every class that is not the least of its component."""
    keys = _keys(classes)
    shared = (
        keys.groupBy("key")
        .agg(F.min("digest").alias("leader"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    members = materialize(keys.join(shared, "key"), "members")
    known = materialize(
        classes.join(members.select("digest").distinct(), "digest"), "candidates"
    )
    sets = materialize(_sets(docs, known.select("rep", "digest"), key, text), "sets")
    finder = _Finder(known, sets, percent)
    first = members.filter("digest <> leader").select(
        F.col("leader").alias("a"), F.col("digest").alias("b")
    )
    checked = materialize(finder.near(first.distinct()), "checked")
    roots = components(materialize(finder.linked(checked), "links"))
    state = _unfinished(_rooted(members.filter("digest <> leader").drop("leader"), roots))
    state = materialize(state.select("key", "digest"), "unfinished")
    state = materialize(state.join(_shareable(sets, state), "digest"), "unfinished")
    state = materialize(_dealt(_linkable(state, percent), sets, percent), "dealt")
    discard(members)
    compared = _Compared(finder, checked, roots)
    active = materialize(_unfinished(_rooted(state, roots)), "active")
    for probe in range(PROBES):
        if active.isEmpty():
            break
        compared.add(_pairs(active, _representatives(active, probe), percent))
        before = active
        active = materialize(_unfinished(_rooted(_bare(active), compared.roots)), "active")
        discard(before)
    slots = LEADERS
    while not active.isEmpty():
        leaders = materialize(_leaders(active, slots), "leaders")
        compared.add(_pairs(active, leaders, percent))
        used = leaders.select("key", F.col("a").alias("digest"))
        rest = active.join(used, ["key", "digest"], "left_anti")
        before = active
        active = materialize(_unfinished(_rooted(_bare(rest), compared.roots)), "active")
        discard(before)
        discard(leaders)
        slots *= GROWTH
    return compared.roots


def _bare(active: DataFrame) -> DataFrame:
    return active.select("key", "digest", "n", "s", "place")


def _pairs(active: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """The members of each group with those of ``others`` that they may be linked with."""
    # What both may have in common: shared shingles, and none before their place.
    rest = F.least(F.col("n") - F.col("place"), F.col("n_a") - F.col("place_a")) + 1
    common = F.least("s", "s_a", rest)
    possible = common * (100 + percent) >= percent * (F.col("n") + F.col("n_a"))
    return (
        others.join(
            active,
            (others["key"] == active["key"]) & (F.col("root") != F.col("root_a")) & possible,
        )
        .select(F.least("a", "digest").alias("a"), F.greatest("a", "digest").alias("b"))
        .distinct()
    )


class _Compared:
    """The pairs compared so far and the components they have given."""

    def __init__(self, finder: _Finder, pairs: DataFrame, roots: DataFrame) -> None:
        self.finder, self.pairs, self.roots = finder, pairs, roots

    def add(self, pairs: DataFrame) -> None:
        """Compare pairs that were not compared before."""
        # Another key may have led to a pair before.
        known = self.pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        fresh = materialize(pairs.join(known, ["a", "b"], "left_anti"), "fresh")
        if fresh.isEmpty():
            return
        self.pairs = self.pairs.unionByName(fresh)
        more = materialize(self.finder.linked(fresh), "links")
        if not more.isEmpty():
            so_far = self.roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            before, self.roots = self.roots, components(more.unionByName(so_far))
            discard(before)
        discard(more)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Id, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    signed = materialize(signatures(docs, key, text), "signatures")
    usable = signed.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = materialize(
        usable.groupBy("digest").agg(
            F.min("id").alias("rep"), F.any_value("signature").alias("signature")
        ),
        "classes",
    )
    roots = links(docs, classes, key, text, percent)
    # Different texts under one id belong together.
    spread = (
        usable.groupBy("id")
        .agg(F.min("digest").alias("a"), F.max("digest").alias("z"))
        .filter("a <> z")
        .select("id", "a")
    )
    same_id = materialize(
        usable.join(spread, "id").select("a", F.col("digest").alias("b")), "same-id"
    )
    if not same_id.isEmpty():
        roots = components(
            same_id.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        )
    placed = classes.select("digest", "rep").join(
        roots.select(F.col("node").alias("digest"), "root"), "digest", "left"
    )
    placed = materialize(
        placed.select("digest", "rep", F.coalesce("root", "digest").alias("root")), "placed"
    )
    least = placed.groupBy("root").agg(F.min("rep").alias("component"))
    named = placed.join(least, "root").select("digest", "component")
    own = usable.join(named, "digest").select("id", "n_shingles", "component")
    rest = signed.filter("n_shingles = 0 OR id IS NULL").select(
        "id", "n_shingles", F.col("id").alias("component")
    )
    return own.unionByName(rest).select(
        F.col("id").alias(key),
        "n_shingles",
        F.col("component").alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"),
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The documents of which no smaller id is in the same component.

    Rows without id stay.
    """
    dropped = (
        near_duplicates(docs, key, text, percent)
        .filter(~F.col("kept"))
        .select(F.col(key).alias("__dropped"))
        .distinct()
    )
    return docs.join(dropped, F.col(f"`{key}`") == F.col("__dropped"), "left_anti")
