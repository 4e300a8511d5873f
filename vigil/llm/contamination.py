"""Benchmark decontamination: documents are scanned for the word windows of a test set.

The windows of every benchmark item (``n`` consecutive normalised words; a shorter item is one
window) become a set of hashes that is broadcast. Each document's windows are looked up in one
vectorised scan, first in a small bitmap and then in the sorted hashes; every hit is confirmed
on the words themselves. Documents are never shuffled.

The set is counted before it is broadcast. One of more than ``block`` windows is dealt into
blocks by hash; each block is a pass of its own, and a table is written between passes.

Defined cases: null and empty texts have no words and are clean; an item without words never
occurs; a null item id counts as the empty id; rows that repeat an item id are one item; empty
tables give no hits; other columns are passed on, but those named as the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from vigil.llm.common import Scratch, lean
from vigil.llm.words import PUNCTUATION, Words, joined, runs, split

BLOCK = 2_000_000
_HITS = "__hits__"

_WINDOWS = "item string, n int, hash long, words binary"


def _item_windows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = split(batch.column(1), PUNCTUATION, lower=True)
            hashes = {}
            out = []
            for i, item in enumerate(batch.column(0).to_pylist()):
                size = int(words.first[i + 1] - words.first[i])
                if size == 0:
                    continue
                m = min(n, size)
                if m not in hashes:
                    hashes[m] = runs(words, m)[0].view(np.int64)
                for at in range(size - m + 1):
                    text = b" ".join(words.words(i, at, at + m))
                    out.append((item or "", m, int(hashes[m][words.first[i] + at]), text))
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["item", "n", "hash", "words"],
            )

    return run


class WindowSet:
    """Windows by length: sorted hashes with a bitmap in front, and the words behind each hash."""

    BITS = 20

    def __init__(self, windows: list):
        self.texts: dict[int, dict[int, dict[bytes, set]]] = defaultdict(dict)
        for item, n, hash_, text in windows:
            same = self.texts[n].setdefault(hash_ & (1 << 64) - 1, {})
            same.setdefault(bytes(text), set()).add(item)
        self.hashes = {n: np.array(sorted(by), dtype=np.uint64) for n, by in self.texts.items()}
        self.bitmap = {}
        for n, hashes in self.hashes.items():
            bits = np.zeros(1 << self.BITS, dtype=bool)
            bits[hashes >> np.uint64(64 - self.BITS)] = True
            self.bitmap[n] = bits

    def find(self, words: Words) -> Iterator[tuple[int, int, int, set]]:
        """Text, first word, number of words and items of every window that occurs."""
        for n, known in self.hashes.items():
            hashes, inside = runs(words, n)
            at = np.flatnonzero(self.bitmap[n][hashes >> np.uint64(64 - self.BITS)] & inside)
            place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
            at = at[known[place] == hashes[at]]
            text = np.searchsorted(words.first, at, side="right") - 1
            for i, word in zip(text.tolist(), at.tolist()):
                start = word - int(words.first[i])
                said = b" ".join(words.words(i, start, start + n))
                items = self.texts[n][int(hashes[word])].get(said)
                if items:
                    yield i, start, n, items


_HIT_TYPE = ArrayType(
    StructType(
        [
            StructField("start", IntegerType()),
            StructField("words", IntegerType()),
            StructField("items", ArrayType(StringType())),
        ]
    )
)
_HIT_ARROW = pa.list_(
    pa.struct([("start", pa.int32()), ("words", pa.int32()), ("items", pa.list_(pa.string()))])
)

_RESULT = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("n_items", LongType()),
    StructField("items", ArrayType(StringType())),
    StructField("items_sha256", StringType()),
    StructField("contaminated", BooleanType()),
    StructField("clean_text", StringType()),
]


def _marked(size: int, hits: list[dict]) -> np.ndarray:
    edge = np.zeros(size + 1, dtype=np.int64)
    for hit in hits:
        edge[hit["start"]] += 1
        edge[hit["start"] + hit["words"]] -= 1
    return np.cumsum(edge)[:size] > 0


def _scan(sent, last: bool, cleaned: bool, names: list[str]):
    """One pass over the documents; the last column holds the hits of earlier passes.
    Columns ``names`` are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: WindowSet = sent.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            words = split(column, PUNCTUATION, lower=True)
            hits = [h or [] for h in batch.columns[-1].to_pylist()]
            for i, start, n, items in known.find(words):
                hits[i].append({"start": start, "words": n, "items": sorted(items)})
            rest = [batch.column(batch.schema.get_field_index(name)) for name in names]
            if not last:
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(hits, _HIT_ARROW)], names=[*names, _HITS]
                )
                continue
            sizes = np.diff(words.first)
            marks = [_marked(int(s), h) if h else None for s, h in zip(sizes, hits)]
            items = [sorted({x for hit in h for x in hit["items"]}) for h in hits]
            clean = [
                None if mark is None or not cleaned else joined(words, i, ~mark).decode()
                for i, mark in enumerate(marks)
            ]
            n_hit = [0 if mark is None else int(mark.sum()) for mark in marks]
            results = [
                pa.array(sizes, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array(items, pa.list_(pa.string())),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                pa.array([n > 0 for n in n_hit]),
                pa.array(clean, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*rest, *results], names=[*names, *(f.name for f in _RESULT)]
            )

    return run


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    block: int = BLOCK,
    cleaned: bool = False,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurring window), ``n_items`` and
    ``items`` (ids, sorted as text), ``items_sha256``, ``contaminated`` and, if ``cleaned``, the
    ``clean_text`` of contaminated rows: normalised words without those hit. Without
    ``with_text`` the text itself is left out of the result."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    windows = scratch.put(
        benchmark.select(F.col("item_id").cast("string"), "text")
        .mapInArrow(lean(_item_windows(n)), _WINDOWS)
        .distinct(),
        "windows",
    )
    blocks = max(1, -(-windows.count() // block))
    rest = docs.drop(*(f.name for f in _RESULT))
    rows = rest.withColumn(_HITS, F.lit(None).cast(_HIT_TYPE))
    for number in range(blocks):
        part = windows.filter(F.pmod("hash", F.lit(blocks)) == number) if blocks > 1 else windows
        sent = spark.sparkContext.broadcast(WindowSet(part.collect()))
        last = number == blocks - 1
        kept = [f for f in rest.schema if with_text or not last or f.name != "text"]
        added = _RESULT if last else [StructField(_HITS, _HIT_TYPE)]
        scan = _scan(sent, last, cleaned, [f.name for f in kept])
        rows = rows.mapInArrow(lean(scan), StructType(kept + added))
        if not last:
            rows = scratch.put(rows, f"pass{number}")
    return rows


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, spans: bool = False
) -> DataFrame:
    """``docs`` without contaminated rows or, with ``spans``, with their hit words removed
    (the text is then the remaining normalised words). Columns named as the results go."""
    found = find_contamination(docs, benchmark, n, cleaned=spans)
    names = [c for c in docs.columns if c not in {f.name for f in _RESULT}]
    if spans:
        text = F.when(F.col("contaminated"), F.col("clean_text")).otherwise(F.col("text"))
        return found.withColumn("text", text).select(*names)
    return found.filter(~F.col("contaminated")).select(*names)
