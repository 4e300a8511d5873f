"""MinHash near-dedup with tensored banding.

A document's set is its distinct word shingles. Equal sets form a class first; classes are
compared, not copies. ``HALVES`` collections of ``HALF`` minimum hashes are computed per set.
Every pair of collections is one hash table, so 20 collections give 190 tables of six hashes
for 60 minimum hashes instead of 1,140. A pair of sets of similarity 0.8 meets in no table with
probability 1.3e-5 (fewer than two of 20 collections agree, each does with 0.8^3); the miss
falls fast above (3e-9 at 0.9). Collections that no other set shares cannot form a shared key,
so they are dropped before keys are paired.

Candidates are never expanded into all pairs of a bucket. A shingle that no other candidate has
cannot be in an intersection; counting those bounds the similarity of a set to any other, which
rules out sets and pairs exactly. The set of a bucket with the fewest shingles of its own is its
hub, and all others are compared with it. What is then still in another component than a hub is
compared with the members of such buckets through their rarest shingles: prefix and positional
filters rule out all pairs but a few, exactly. All links are confirmed on the full sets of 64-bit
shingle hashes. Components come from alternating large-star and small-star steps.

Defined cases: null texts and texts without words have an empty set, linked with nothing; with
fewer words than a shingle the whole sequence is the one shingle; rows that repeat an id are
ordered by text; an empty table gives an empty result; extra columns are passed on or not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ROW, Scratch, keyed, lean
from vigil.llm.words import Words, mix, runs, split

HALVES = 20
HALF = 3
_FOUND = "__component__"

_SIGNED = "row long, n long, set_a long, set_b long, halves array<long>"


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of every text, and where each text's begin (with the end)."""
    group, inside = runs(words, k)
    sizes = np.diff(words.first)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    keep = inside.copy()
    out = group.copy() if len(group) else np.zeros(0, dtype=np.uint64)
    keep[words.first[short]] = True
    for size in np.unique(sizes[short]):
        at = words.first[short[sizes[short] == size]]
        out[at] = mix(runs(words, int(size))[0][at] + np.uint64(size))
    ends = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], ends[words.first]


def distinct_sorted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text in ascending order, and where each text's begin."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    starts = np.searchsorted(text[new], np.arange(len(first)))
    return hashes[new], starts


def _sum_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of each text's values."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[first[1:]] - total[first[:-1]]


def _sign(k: int, halves: int, half: int):
    seeds = mix(np.arange(1, 2 * halves * half + 1, dtype=np.uint64))
    flips, factors = seeds[::2], seeds[1::2] | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = shingles(split(batch.column(1), lower=True), k)
            hashes, first = distinct_sorted(hashes, first)
            filled = np.flatnonzero(np.diff(first))
            signature = np.zeros((len(first) - 1, halves), dtype=np.uint64)
            for i in range(halves * half if len(filled) else 0):
                value = (hashes ^ flips[i]) * factors[i]
                value ^= value >> np.uint64(32)
                least = np.minimum.reduceat(value, first[filled])
                column = signature[:, i // half]
                column[filled] = mix(column[filled] + least + np.uint64(i))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(first)),
                    pa.array(_sum_by(mix(hashes), first).view(np.int64)),
                    pa.array(_sum_by(mix(hashes ^ flips[0]), first).view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(first)) * halves, pa.int32()),
                        pa.array(signature.view(np.int64).ravel()),
                    ),
                ],
                names=["row", "n", "set_a", "set_b", "halves"],
            )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = distinct_sorted(*shingles(split(batch.column(1), lower=True), k))
            sets = [hashes[a:b].tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=["row", "set"]
            )

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, row) for every member of every set."""
    for batch in batches:
        for start in range(0, batch.num_rows, 100):
            part = batch.slice(start, 100)
            sets = [np.frombuffer(s.as_buffer(), dtype=np.int64) for s in part.column(1)]
            rows = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sets)), pa.array(rows)], names=["h", "row"]
            )


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2), batch.column(3)):
                left = np.frombuffer(a.as_buffer(), dtype=np.uint64)
                right = np.frombuffer(b.as_buffer(), dtype=np.uint64)
                at = np.searchsorted(right, left)
                both = int((right[np.minimum(at, len(right) - 1)] == left).sum())
                union = len(left) + len(right) - both
                linked.append(100 * both >= percent * union)
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), keep], names=["a", "b", "linked"]
            )

    return run


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the least node that it reaches.

    Each step links all larger neighbours of a node, then all smaller ones, to the least of
    them; the number of steps grows with the logarithm of the longest path.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links, step = links.filter("u <> v").distinct(), 0
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), "m").distinct()
        down = large.groupBy("u").agg(F.min("m").alias("least"))
        small = large.join(down, "u")
        links = (
            small.select("u", F.col("least").alias("v"))
            .unionByName(
                small.filter("m <> least").select(F.col("m").alias("u"), F.col("least").alias("v"))
            )
            .distinct()
        )
        links = scratch.put(links, f"{label}-{step}")
        if step:
            scratch.drop(f"{label}-{step - 1}")
        if links.join(links.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break  # no centre has a centre: every component is a star
        step += 1
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


class _Links:
    """Candidate pairs confirmed so far and the components that they form."""

    def __init__(self, sets: DataFrame, scratch: Scratch, percent: int):
        self.sets, self.scratch, self.percent = sets, scratch, percent
        self.tested: DataFrame | None = None
        self.labels: DataFrame | None = None
        self.rounds = 0

    def test(self, pairs: DataFrame) -> None:
        """Confirm pairs (x, y) that are not tested yet."""
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested.select("a", "b"), ["a", "b"], "left_anti")
        both = (
            pairs.join(self.sets.select(F.col("row").alias("a"), F.col("set").alias("left")), "a")
            .join(self.sets.select(F.col("row").alias("b"), F.col("set").alias("right")), "b")
            .select("a", "b", "left", "right")
        )
        self.rounds += 1
        done = both.mapInArrow(lean(_confirm(self.percent)), "a long, b long, linked boolean")
        done = self.scratch.put(done, f"tested{self.rounds}")
        self.tested = done if self.tested is None else self.tested.unionByName(done)
        self.labels = components(
            self.tested.filter("linked"), self.scratch, f"components{self.rounds}"
        )

    def label(self, rows: DataFrame, column: str, out: str) -> DataFrame:
        """Adds the component of ``column``; a node without links is its own."""
        labels = self.labels.withColumnsRenamed({"node": column, "component": out})
        return rows.join(labels, column, "left").withColumn(out, F.coalesce(out, column))


def _keys(reps: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, key) of every table key made of collections that several sets share."""
    half = reps.select("row", F.posexplode("halves").alias("t", "h"))
    half = half.select("row", F.xxhash64("t", "h").alias("h"))
    shared = half.groupBy("h").count().filter("count > 1").select("h")
    shared = scratch.put(shared, "halves")
    several = (
        half.join(shared, "h")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("h")).alias("hs"))
        .filter(F.size("hs") > 1)
    )
    pair = F.transform(
        "hs",
        lambda x, i: F.transform(
            F.slice("hs", i + 2, F.size("hs")), lambda y: F.xxhash64(x, y)
        ),
    )
    return scratch.put(several.select("row", F.explode(F.flatten(pair)).alias("key")), "keys")


def _possible(percent: int, x: str, y: str):
    """Whether two sets can be linked, going by sizes ``n`` and sizes without own shingles ``e``."""
    most = F.least(f"{x}.e", f"{y}.e")
    return (100 + percent) * most >= percent * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _link(rows: DataFrame, reps: DataFrame, k: int, percent: int, scratch: Scratch):
    """Components of the classes' representatives, or None without candidates."""
    keys = _keys(reps, scratch)
    if keys.isEmpty():
        return None
    texts = rows.select(F.col(ROW).alias("row"), "text")
    texts = texts.join(keys.select("row").distinct(), "row")
    sets = texts.select("row", "text").mapInArrow(lean(_sets(k)), "row long, set binary")
    sets = scratch.put(sets, "sets")

    listed = sets.mapInArrow(lean(_members), "h long, row long")
    holders = listed.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    own = holders.filter("n = 1").groupBy("row").agg(F.count(F.lit(1)).alias("own"))
    sizes = sets.select("row", F.expr("length(set) div 8").alias("n")).join(own, "row", "left")
    sizes = sizes.select("row", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("e"))
    sizes = scratch.put(sizes.filter(100 * F.col("e") >= percent * F.col("n")), "sizes")

    sized = keys.join(sizes, "row").select("key", F.struct("row", "n", "e").alias("x"))
    sized = scratch.put(sized, "sized")
    hubs = sized.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"),
        F.min(F.struct((-F.col("x.e") / F.col("x.n")).alias("r"), "x")).alias("least"),
    )
    hubs = hubs.filter("members > 1").select("key", F.col("least.x").alias("hub"))
    hubs = scratch.put(hubs, "hubs")
    placed = scratch.put(sized.join(hubs, "key"), "placed")
    links = _Links(sets, scratch, percent)

    with_hub = placed.filter("x.row <> hub.row").filter(_possible(percent, "x", "hub"))
    links.test(with_hub.select(F.col("x.row").alias("x"), F.col("hub.row").alias("y")))

    members = placed.select("key", "x", F.col("x.row").alias("xr"), F.col("hub.row").alias("hr"))
    members = links.label(links.label(members, "xr", "c"), "hr", "hub_c")
    members = scratch.put(members.select("key", "x.row", "c", "hub_c"), "members")
    apart = members.filter("c <> hub_c")
    minor = apart.select("row").distinct().withColumn("minor", F.lit(True))
    mates = members.join(apart.select("key").distinct(), "key", "left_semi")
    mates = mates.groupBy("row").agg(F.first("c").alias("c")).join(minor, "row", "left")
    mates = mates.select("row", "c", F.coalesce("minor", F.lit(False)).alias("minor"))
    mates = scratch.put(mates, "mates")
    links.test(_prefix_pairs(sets.join(mates, "row"), percent))
    return links


def _prefix_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of rows in different components, x a minor one, that prefix and positional
    filters cannot rule out.

    Shingles are ordered from rare to frequent. Linked sets share a shingle among the first
    n - ceil(percent * n / 100) + 1 of each, and the first shared one leaves at most as many
    common shingles as follow it in either.
    """
    n = F.expr("length(set) div 8")
    info = rows.select("row", "c", "minor", n.cast("int").alias("n"))
    listed = rows.select("row", "set").mapInArrow(lean(_members), "h long, row long")
    often = listed.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ordered = (
        listed.join(often, "h")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("list"))
        .join(info, "row")
        .withColumn("own", F.col("n") - F.size("list"))
        .withColumn("prefix", F.expr(f"n - ({percent} * n + 99) div 100 + 1 - own"))
        .select("row", "c", "minor", "n", "own", F.expr("slice(list, 1, cast(greatest(prefix, 0) AS int))").alias("list"))
        .select("row", "c", "minor", "n", "own", F.posexplode("list").alias("i", "w"))
        .withColumn("left", F.col("n") - F.col("own") - F.col("i"))
        .select("w.h", F.struct("row", "c", "minor", "left", "n").alias("x"))
    )
    other = ordered.withColumnRenamed("x", "y")
    most = F.least("x.left", "y.left")
    fits = (100 + percent) * most >= percent * (F.col("x.n") + F.col("y.n"))
    apart = F.col("x.minor") & (F.col("x.c") != F.col("y.c"))
    pairs = ordered.filter("x.minor").join(other, "h").filter(apart & fits)
    return pairs.select(F.col("x.row").alias("x"), F.col("y.row").alias("y"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    halves: int = HALVES,
    half: int = HALF,
) -> DataFrame:
    """``docs`` (without its text) with ``n_shingles``, ``component_id`` (least id of the rows
    reachable over links) and ``kept`` (the row of that id).

    Two rows are linked when 100 * intersection >= percent * union of their shingle sets.
    """
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, scratch)
    labelled = _labels(rows, shingle, percent, halves, half, scratch)
    rest = rows.drop("text", "n_shingles", "component_id", "kept")
    labelled = labelled.withColumnsRenamed({"row": ROW, "component": _FOUND})
    out = rest.join(labelled, ROW)
    if "keyed" in scratch.paths:
        ids = rows.select(F.col(ROW).alias(_FOUND), F.col("doc_id").alias("component_id"))
        out = out.join(ids, _FOUND)
    else:
        out = out.withColumn("component_id", F.col(_FOUND))
    kept = F.col(ROW) == F.col(_FOUND)
    return out.withColumn("kept", kept).drop(ROW, _FOUND)


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of near-duplicates: the least id."""
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, scratch)
    labelled = _labels(rows, shingle, percent, HALVES, HALF, scratch)
    kept = scratch.put(
        labelled.filter("row = component").select(F.col("row").alias(ROW)), "kept"
    )
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


def _labels(
    rows: DataFrame, shingle: int, percent: int, halves: int, half: int, scratch: Scratch
) -> DataFrame:
    """(row, n_shingles, component) for every row."""
    signed = rows.select(ROW, "text").mapInArrow(lean(_sign(shingle, halves, half)), _SIGNED)
    signed = scratch.put(signed, "signed")
    filled = signed.filter("n > 0")
    key = ["n", "set_a", "set_b"]
    classes = scratch.put(filled.groupBy(*key).agg(F.min("row").alias("rep")), "classes")
    members = filled.join(classes, key).select("row", "n", "rep")
    reps = filled.join(classes.select(F.col("rep").alias("row")), "row").select("row", "halves")
    links = _link(rows, reps, shingle, percent, scratch)
    if links is None:
        labelled = members.withColumn("component", F.col("rep"))
    else:
        labelled = links.label(members, "rep", "component")
    alone = signed.filter("n = 0").select("row", "n", F.col("row").alias("component"))
    labelled = labelled.select("row", "n", "component").unionByName(alone)
    return scratch.put(labelled.withColumnRenamed("n", "n_shingles"), "labels")
