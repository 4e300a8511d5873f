"""Prefix trie of conversations, built and summed by van Emde Boas recursion.

The trie of sequences of at most 2^K turns is cut at half depth. What is above the cut is the
upper trie, whose sequences are the first halves; what hangs below each distinct first half is a
forest of second halves. Both are cut again, down to single turns. All parts of one size are
worked on together, by joins of whole tables, so there are K rounds where a walk by depth would
take as many as the longest conversation has turns; the rows of round k shrink with 2^k.

* Up: runs of 2^k turns, at multiples of 2^k, are named from the names of their halves.
* Down: for k from K - 1 to 0, a prefix at a multiple of 2^(k+1) and the run of 2^k turns behind
  it name the cut prefix at half depth. A depth is reached once, in the round of its lowest bit.
* Totals: for k from 0 to K - 1, the totals of the trees that hang at cuts of size 2^k, already
  complete within their part, are grafted on the nodes of the part above, which lie on the path
  of any member.

Names are SHA-256 digests of what they name, so that equal prefixes have equal names wherever
they are made, without a table of names. A conversation is no group anywhere: its turns are
numbered in parts, and all other steps deal by (conversation, part) or by name.

Defined cases: turns without a conversation id belong to none. Turns are ordered by ``turn``,
nulls first, then by role and text; null role or text is empty; repeated rows are repeated turns.
A conversation without turns is a member of the root. Texts are hashed whole. Without
conversations there is no node. Other input columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import Scratch, lean
from vigil.plans.ordered import running_totals

TURNS_PER_BUCKET = 4096
IDS_PER_CHUNK = 4096
_SPACES = r"[\x20\x09-\x0D]+"


def _digest(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, name, words): every turn by its place from 0, the digest of its role and
    text, and the words of its text."""
    known = conversations.filter("conv_id is not null").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    bucket = F.floor(F.col("turn") / TURNS_PER_BUCKET)
    placed = running_totals(
        known, ["conv_id"], bucket, ["turn", "role", "text"], {"place": F.lit(1).cast("long")}
    )
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    words = F.size(F.array_remove(F.split("text", _SPACES), ""))
    return placed.select(
        "conv_id",
        (F.col("place") - 1).alias("at"),
        _digest(said).alias("name"),
        words.cast("long").alias("words"),
    )


def borrowed(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of another one, and the ids of all.

    ``turns`` are rows of ``numbered``. Conversation c begins with the first h turns of
    conversation c - c % every, h = crc32(c) % most, and goes on with its own after its first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    ids = sizes.select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("lender"),
    )
    lenders = sizes.select(F.col("conv_id").alias("lender"), F.col("size").alias("lent"))
    lent = F.least("h", F.coalesce("lent", F.lit(0).cast("long")))
    ids = ids.join(lenders, "lender", "left").withColumn("lent", lent)
    heads = turns.filter(F.col("at") < most - 1).withColumnRenamed("conv_id", "lender")
    first = ids.join(heads, "lender").filter(F.col("at") < F.col("h"))
    own = turns.join(ids, "conv_id").filter(F.col("at") >= F.col("h"))
    own = own.withColumn("at", F.col("at") - F.col("h") + F.col("lent"))
    columns = ["conv_id", "at", "name", "words"]
    return first.select(*columns).unionByName(own.select(*columns)), ids.select("conv_id")


def _runs(turns: DataFrame, rounds: int, scratch: Scratch) -> list[DataFrame]:
    """(conv_id, at, name, words) of complete runs of 2^k turns for every k below ``rounds``;
    ``at`` counts runs, ``words`` are those of the last turn."""
    levels = [turns]
    right = F.col("at") % 2 == 1
    for k in range(1, rounds):
        halves = levels[-1].groupBy("conv_id", F.shiftright("at", 1).alias("half")).agg(
            F.max(F.when(~right, F.col("name"))).alias("first"),
            F.max(F.when(right, F.col("name"))).alias("second"),
            F.max(F.when(right, F.col("words"))).alias("words"),
        )
        whole = halves.filter("first is not null and second is not null").select(
            "conv_id",
            F.col("half").alias("at"),
            _digest(F.concat("first", "second")).alias("name"),
            "words",
        )
        levels.append(scratch.put(whole, f"runs{k}"))
    return levels


def _prefixes(ids: DataFrame, runs: list[DataFrame], scratch: Scratch) -> DataFrame:
    """(conv_id, depth, name, words): every prefix of every conversation, the empty one too."""
    root = ids.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        _digest(F.lit("")).alias("name"),
        F.lit(0).cast("long").alias("words"),
    )
    made = [scratch.put(root, "root")]
    for k in reversed(range(len(runs))):
        behind = runs[k].filter(F.col("at") % 2 == 0).select(
            "conv_id",
            F.shiftleft("at", k).alias("depth"),
            F.col("name").alias("run"),
            F.col("words").alias("last"),
        )
        cut = _union(made).join(behind, ["conv_id", "depth"]).select(
            "conv_id",
            (F.col("depth") + (1 << k)).alias("depth"),
            _digest(F.concat("name", "run")).alias("name"),
            F.col("last").alias("words"),
        )
        made.append(scratch.put(cut, f"prefixes{k}"))
    return _union(made)


def _nodes(prefixes: DataFrame, scratch: Scratch) -> DataFrame:
    """(name, depth, conv_id, n_convs, words, parent): distinct prefixes by their least member."""
    distinct = prefixes.groupBy("name", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
    )
    above = prefixes.select(
        "conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent")
    )
    return scratch.put(distinct.join(above, ["conv_id", "depth"], "left"), "nodes")


def _totals(own: DataFrame, prefixes: DataFrame, rounds: int, scratch: Scratch) -> DataFrame:
    """(name, leaves, saved): ``own`` (name, depth, conv_id, leaves, saved) summed over subtrees."""
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    parts = [own.select("name", "depth", "conv_id", "leaves", "saved")]
    for k in range(rounds):
        part = k + 1  # the cut lies in the middle of a part of 2^part depths
        cut = F.col("depth").bitwiseAND((1 << part) - 1) == 1 << k
        hanging = _union([x.filter(cut) for x in parts]).groupBy("name").agg(
            F.max("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums
        )
        hanging = hanging.select(
            "conv_id", F.shiftright("depth", part).alias("part"), "leaves", "saved"
        )
        above = prefixes.filter(F.col("depth").bitwiseAND(1 << k) == 0).select(
            "conv_id", F.shiftright("depth", part).alias("part"), "name", "depth"
        )
        grafted = above.join(hanging, ["conv_id", "part"]).groupBy("name", "depth").agg(*sums)
        grafted = grafted.withColumn("conv_id", F.lit(None).cast("long"))  # known to ``own``
        parts.append(scratch.put(grafted, f"grafted{k}"))
    return _union(parts).groupBy("name").agg(*sums)


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per name from rows (name, chunk) in order; holds one digest at a time."""
    names = ["name", "ends_sha256"]
    current, digest = None, None
    for batch in batches:
        done = []
        for name, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name == current:
                digest.update(b"," + chunk.encode())
                continue
            if current is not None:
                done.append((current, digest.hexdigest()))
            current, digest = name, hashlib.sha256(chunk.encode())
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names=names)
    if current is not None:
        last = [pa.array([current]), pa.array([digest.hexdigest()])]
        yield pa.RecordBatch.from_arrays(last, names=names)


def _ends(turns: DataFrame, ids: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(name, ends_sha256) of nodes at which conversations end, over their ids in order.

    Ids are put together in chunks of a range of ids first, so that the one task that must
    digest all of a node's ids in order reads few rows, one after the other.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    depth = F.coalesce("size", F.lit(0).cast("long")).alias("depth")
    whole = ids.join(sizes, "conv_id", "left").select("conv_id", depth)
    ended = prefixes.select("conv_id", "depth", "name").join(whole, ["conv_id", "depth"])
    chunk = F.floor(F.col("conv_id") / IDS_PER_CHUNK).alias("chunk")
    chunks = ended.groupBy("name", chunk).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ","
        ).alias("ids")
    )
    ordered = chunks.repartition("name").sortWithinPartitions("name", "chunk")
    return ordered.select("name", "ids").mapInArrow(
        lean(_digest_chunks), "name binary, ends_sha256 string"
    )


def trie(turns: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node of the trie of ``turns`` (as of ``numbered``); ``ids`` are all members of
    the root, those without turns too.

    ``conv_id`` and ``depth`` name a node by its least member; ``parent_conv_id`` is null for the
    root. ``n_leaves`` and ``saved_tokens`` (words of the last text that members after the first
    need not pay again) are totals of the subtree, and ``ends_sha256`` digests the ids that end
    at the node.
    """
    longest = turns.agg(F.max("at")).first()[0]
    rounds = 0 if longest is None else (longest + 1).bit_length()
    runs = _runs(turns, rounds, scratch) if rounds else []
    prefixes = _prefixes(ids, runs, scratch)
    nodes = _nodes(prefixes, scratch)
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    zero = F.lit(0).cast("long")
    own = scratch.put(
        nodes.join(children, "name", "left").select(
            *nodes.columns,
            F.coalesce("n_children", zero).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        "own",
    )
    totals = _totals(own, prefixes, rounds, scratch)
    parents = own.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        own.drop("leaves", "saved")
        .join(totals, "name")
        .join(_ends(turns, ids, prefixes), "name", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are."""
    turns = scratch.put(numbered(conversations), "turns")
    return trie(turns, turns.select("conv_id").distinct(), scratch)
