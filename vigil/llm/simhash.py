"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

Terms are the distinct lower-cased words of a text, each once: an edited word changes one term,
and words that a text repeats do not outvote the rest. The bits of a term's hash vote for or
against the bits of the fingerprint.

Two fingerprints within radius r differ by at most one bit in one of r // 2 + 1 blocks of bits.
Each block, moved to the front, is the key of one table, and a query looks up its own block and
those with one bit flipped. Equal fingerprints are one entry with a count, a pair is reported by
its first meeting table only, and the distance is part of the join.

Defined cases: null texts are empty; texts without words have the fingerprint of zeros; rows
that repeat an id follow each other by text; a single row is followed by itself; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ROW, Scratch, keyed, lean
from vigil.llm.words import mix, split

LONGS = 4
BITS = 64 * LONGS
# Distances of near copies (five-word Jaccard from 0.8 to below 1) in the test tables: median 16, at most 27.
RADIUS = 27
EXACT = 12  # up to this radius blocks of twenty bits are found without flips

# For each byte, its eight bits in eight counters of one byte.
_SPREAD = np.zeros(256, dtype=np.uint64)
for _bit in range(8):
    _SPREAD += (np.arange(256, dtype=np.uint64) >> np.uint64(_bit) & np.uint64(1)) << np.uint64(
        8 * _bit
    )
_RUN = 255  # terms that byte counters can add up


def _ones(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many of each text's hashes have each bit set."""
    texts = len(first) - 1
    out = np.zeros((texts, 64), dtype=np.int64)
    sizes = np.diff(first)
    pieces = -(-sizes // _RUN)
    owner = np.repeat(np.arange(texts), pieces)
    if not len(owner):
        return out
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = first[owner] + nth * _RUN
    begin = np.searchsorted(owner, np.flatnonzero(pieces))
    bytes_ = hashes.view(np.uint8).reshape(-1, 8)
    for place in range(8):
        counters = np.add.reduceat(_SPREAD[bytes_[:, place]], starts)
        counts = counters.view(np.uint8).reshape(-1, 8).astype(np.int64)
        out[pieces > 0, 8 * place : 8 * place + 8] = np.add.reduceat(counts, begin, axis=0)
    return out


def fingerprints(column: pa.Array) -> np.ndarray:
    """One row of BITS / 8 bytes per text."""
    words = split(column, lower=True)
    owner = np.repeat(np.arange(len(words)), np.diff(words.first))
    order = np.lexsort((words.hash, owner))
    owner, terms = owner[order], words.hash[order]
    new = np.ones(len(terms), dtype=bool)
    new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    owner, terms = owner[new], terms[new]
    at = np.searchsorted(owner, np.arange(len(words) + 1))
    votes = np.zeros((len(words), BITS), dtype=np.int64)
    for i in range(LONGS):
        ones = _ones(mix(terms + np.uint64(i + 1)), at)
        votes[:, 64 * i : 64 * i + 64] = 2 * ones - np.diff(at)[:, None]
    return np.packbits(votes > 0, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1.0 - np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one."""
    changed = len(text) // 3
    return text[: len(text) - changed] + following[:changed]


_COMPARED = (
    "doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by bucket in order; the last of each bucket (``closing``) only follows."""
    ids, texts = [], []
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        closing = batch.column(2).to_pylist()
        for doc_id, text, closes in zip(doc_ids, batch.column(1).to_pylist(), closing):
            ids.append((doc_id, closes))
            texts.append(text or "")
        if len(ids) > 1:
            yield _compared(ids, texts)
            ids, texts = ids[-1:], texts[-1:]


def _compared(ids: list[tuple], texts: list[str]) -> pa.RecordBatch:
    """All rows but the last, which the next batch starts with."""
    own = np.array([i for i, (_, closes) in enumerate(ids[:-1]) if not closes], dtype=np.int64)
    prints = fingerprints(pa.array(texts, pa.large_string()))
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    others = fingerprints(pa.array(changed, pa.large_string()))
    mine, following = prints[own], prints[own + 1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[i][0] for i in own]),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([p.tobytes().hex() for p in mine], pa.string()),
            pa.array([p.tobytes().hex() for p in others], pa.string()),
            pa.array(likeness(mine, others), pa.float64()),
            pa.array(likeness(mine, following), pa.float64()),
        ],
        names=[
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            "near_edited",
            "near_next",
        ],
    )


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; the row that
    follows is the one of next smaller id, after the least the one of greatest id.

    Rows are dealt into as many ranges of ids as there are shuffle partitions. Each range also
    gets a copy of the row that follows its last: one row per range, found from the ids alone.
    """
    spark = docs.sparkSession
    rows = keyed(docs.select("doc_id", "text"), Scratch(spark))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = [i / parts for i in range(1, parts)]
    cuts = rows.approxQuantile([ROW], quantiles, 0.2 / parts)[0] if parts > 1 else []
    edges = [-float("inf"), *sorted(set(cuts)), float("inf")]
    ranged = rows.withColumn("place", F.col(ROW).cast("double"))
    if len(edges) > 2:
        cutter = Bucketizer(splits=edges, inputCol="place", outputCol="range")
        ranged = cutter.transform(ranged)
    else:
        ranged = ranged.withColumn("range", F.lit(0.0))
    ranged = ranged.select(ROW, "doc_id", "text", F.col("range").cast("int").alias("range"))
    tops = sorted(ranged.groupBy("range").agg(F.max(ROW)).collect())
    follows = [(tops[i][0], tops[i - 1][1]) for i in range(len(tops))]  # one row per range
    closing = spark.createDataFrame(follows, f"next_range int, {ROW} long")
    copies = ranged.join(F.broadcast(closing), ROW).select(
        ROW, "doc_id", "text", F.col("next_range").alias("range"), F.lit(True).alias("closing")
    )
    both = ranged.select("*", F.lit(False).alias("closing")).unionByName(copies)
    kind = dict(rows.dtypes)["doc_id"]
    return (
        both.repartition(parts, "range")
        .sortWithinPartitions("range", "closing", F.desc(ROW))
        .select("doc_id", "text", "closing")
        .mapInArrow(lean(_compare), _COMPARED.format(kind=kind))
    )


def _long(column: str, i: int) -> Column:
    """The i-th 64 bits of a fingerprint in hexadecimal."""
    high, low = (F.conv(F.substring(column, at, 8), 16, 10).cast("long")
                 for at in (16 * i + 1, 16 * i + 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _masks(blocks: int) -> list[list[tuple[int, int]]]:
    """For each block of bits: the numbers of the longs that it touches, with its bits there."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    out = []
    for a, b in zip(edges, edges[1:]):
        touched = []
        for i in range(LONGS):
            low, high = max(a, 64 * i) - 64 * i, min(b, 64 * i + 64) - 64 * i
            if low < high:
                mask = ((1 << (high - low)) - 1) << low
                touched.append((i, mask - (1 << 64) if mask >> 63 else mask))
        out.append(touched)
    return out


def _lookups(masks: list[list[tuple[int, int]]], flips: int) -> str:
    """SQL of one row per block and looked-up change of it: the block's number, its mask and the
    flipped bits in each long."""
    rows = []
    for j, touched in enumerate(masks):
        mask = dict(touched)
        changes = [{}]
        if flips:
            for i, bits in touched:
                changes += [{i: 1 << k} for k in range(64) if bits >> k & 1]
        for change in changes:
            flip = [x - (1 << 64) if x >> 63 else x for x in (change.get(i, 0) for i in range(LONGS))]
            values = [f"{mask.get(i, 0)}L, {flip[i]}L" for i in range(LONGS)]
            rows.append(f"struct({j}L, {', '.join(values)})")
    return f"inline(array({', '.join(rows)}))"


def near_fingerprints(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, distance, n) for every fingerprint of ``prints`` (fingerprint)
    within ``radius`` of one of ``queries`` (fingerprint); ``n`` rows have it. Where ``prints``
    has a doc_id, its least one with the fingerprint is the ``representative``.

    ``radius`` is at most 31. Up to 12 a block has twenty bits or more and must be equal; above,
    half as many blocks may differ by one bit, so that keys keep sixteen bits or more.
    """
    if not 0 <= radius < 32:
        raise ValueError("radius must be from 0 to 31")
    flips = int(radius > EXACT)
    masks = _masks(radius // 2 + 1 if flips else radius + 1)
    longs = [f"f{i}" for i in range(LONGS)]
    changes = ["block", *(f"{name}{i}" for i in range(LONGS) for name in ("mask", "flip"))]

    def tables(rows: DataFrame, flips: int) -> DataFrame:
        rows = rows.select(*(_long("fingerprint", i).alias(longs[i]) for i in range(LONGS)))
        rows = rows.select("*", F.expr(f"{_lookups(masks, flips)} as ({', '.join(changes)})"))
        bits = [F.col(f).bitwiseAND(F.col(f"mask{i}")).bitwiseXOR(F.col(f"flip{i}"))
                for i, f in enumerate(longs)]
        key = F.shiftleft(F.xxhash64(*bits), 5).bitwiseOR(F.col("block"))  # at most 32 blocks
        return rows.select(*longs, key.alias("key"))

    def text(side: str) -> Column:
        return F.concat(*(F.lpad(F.lower(F.hex(f"{side}.{f}")), 16, "0") for f in longs))

    known = [F.count(F.lit(1)).alias("n")]
    if "doc_id" in prints.columns:
        known.append(F.min("doc_id").alias("representative"))
    entries = tables(prints.select("fingerprint").distinct(), 0).alias("e")
    asked = tables(queries.select("fingerprint").distinct(), flips).alias("q")
    differ = [F.col(f"e.{f}").bitwiseXOR(F.col(f"q.{f}")) for f in longs]
    distance = sum(F.bit_count(d) for d in differ)
    block = F.col("q.key").bitwiseAND(F.lit(31))
    earlier = F.lit(False)
    for j, touched in enumerate(masks[:-1]):
        apart = sum(F.bit_count(differ[i].bitwiseAND(F.lit(mask))) for i, mask in touched)
        earlier |= (block > j) & (apart <= flips)
    met = F.col("e.key") == F.col("q.key")
    pairs = asked.hint("merge").join(entries, met & (distance <= radius) & ~earlier).select(
        text("q").alias("query"),
        text("e").alias("fingerprint"),
        distance.cast("int").alias("distance"),
    )
    found = pairs.join(prints.groupBy("fingerprint").agg(*known), "fingerprint")
    return found.select("query", "fingerprint", "distance", *found.columns[3:])


def name_near(compared: DataFrame, asked: Column, scratch: Scratch) -> DataFrame:
    """``compared`` (doc_id, fingerprint, ...) with ``representative``, the least id of the same
    fingerprint, and, where ``asked`` holds, ``n_near`` and ``near`` (distance, representative, n).

    Only fingerprints that are repeated or asked for are joined with the rows.
    """
    prints = compared.select("doc_id", "fingerprint")
    other = F.when(
        F.col("query") != F.col("fingerprint"), F.struct("distance", "representative", "n")
    )
    found = near_fingerprints(prints, prints.filter(asked)).groupBy("query").agg(
        (F.sum("n") - 1).alias("n_near"), F.sort_array(F.collect_list(other)).alias("near")
    )
    groups = prints.groupBy("fingerprint").agg(
        F.min("doc_id").alias("representative"), F.count(F.lit(1)).alias("members")
    )
    groups = groups.join(found.withColumnRenamed("query", "fingerprint"), "fingerprint", "left")
    groups = groups.filter((F.col("members") > 1) | F.col("n_near").isNotNull())
    groups = scratch.put(groups.drop("members"), "near_groups")
    return compared.join(groups, "fingerprint", "left").select(
        *(F.col(c) for c in compared.columns),
        F.coalesce("representative", "doc_id").alias("representative"),
        *(F.when(asked, F.col(c)).alias(c) for c in ("n_near", "near")),
    )
