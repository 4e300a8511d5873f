"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Terms are lower-cased words, their stems (first ``STEM`` bytes, so that inflected forms count
together), pairs of neighbours and pairs with one word between. Every distinct hashed term of a
text is one binary feature. The learner keeps per-coordinate rates; its L1 term leaves few
weights other than zero, which are broadcast, and every text is scored in one pass.

The learner is sequential, so it works in one task on a bounded sample: the ``sample`` labelled
rows of least hash (a parameter; all labelled rows if there are fewer). The sample's ids are
broadcast to the documents; only features of the sample travel.

Defined cases: null and empty texts have no features and get the score of the bias; rows with a
null label are not learned from; a document labelled twice counts as labelled if any label is
1; without labelled rows every score is 0.5; rows that repeat an id are scored one by one; input
columns named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from vigil.llm.common import lean
from vigil.llm.words import PUNCTUATION, mix, powers, split

BITS = 20
STEM = 5
SAMPLE = 12_000


def terms(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed number and text of every term of the texts, repeats included."""
    words = split(column, PUNCTUATION, lower=True)
    h = words.hash
    text = np.repeat(np.arange(len(words)), np.diff(words.first))
    size = np.minimum(words.end - words.start, STEM)
    stem = np.zeros(len(h), dtype=np.uint64)
    for i in range(STEM if len(h) else 0):
        at = np.minimum(words.start + i, len(words.data) - 1)
        byte = np.where(size > i, words.data[at], 0).astype(np.uint64)
        stem += (byte + np.uint64(1)) * powers(STEM + 2)[i + 1]
    found, owner = [h, mix(stem + np.uint64(1))], [text, text]
    for gap in (1, 2):
        if len(h) > gap:
            same = text[gap:] == text[:-gap]
            pair = mix(h[:-gap] * np.uint64(2 * gap + 1) + mix(h[gap:] + np.uint64(gap)))
            found.append(pair[same])
            owner.append(text[gap:][same])
    number = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
    return number, np.concatenate(owner)


def distinct(
    number: np.ndarray, owner: np.ndarray, texts: int, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of every text, and where each text's begin (with the end)."""
    both = np.unique((owner << bits) | number)
    first = np.searchsorted(both, np.arange(texts + 1) << bits)
    return both & ((1 << bits) - 1), first


@dataclass
class Ftrl:
    """Follow the regularised leader, one text at a time. Feature ``size`` is the bias."""

    size: int
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1

    def __post_init__(self):
        self.z = np.zeros(self.size + 1)
        self.n = np.zeros(self.size + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, self.size)
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(rows: list[tuple[np.ndarray, int]], bits: int, epochs: int, **rates) -> np.ndarray:
    model = Ftrl(1 << bits, **rates)
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            model.learn(*rows[i])
    return model.weights(slice(None)) if rows else np.zeros((1 << bits) + 1)


def _extract(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, first = distinct(*terms(batch.column(0), bits), batch.num_rows, bits)
            listed = pa.ListArray.from_arrays(
                pa.array(first, pa.int32()), pa.array(numbers, pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [listed, batch.column(1), batch.column(2)], names=["at", "label", "place"]
            )

    return run


def _train(bits: int, epochs: int, rates: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            lists, labels = batch.column(0), batch.column(1).to_pylist()
            rows += [(lists[i].values.to_numpy(), label) for i, label in enumerate(labels)]
        weights = train(rows, bits, epochs, **rates)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(weights[at])], names=["at", "weight"]
        )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    bits: int = BITS,
    epochs: int = 3,
    **rates: float,
) -> np.ndarray:
    """Weights (the last is the bias) learned from ``labels`` (doc_id, label) of ``docs``."""
    known = labels.filter("doc_id is not null and label is not null")
    known = known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = chosen.select("text", "label", F.xxhash64("doc_id", "text").alias("place"))
    learned = (
        rows.mapInArrow(lean(_extract(bits)), "at array<int>, label int, place long")
        .repartition(1)
        .sortWithinPartitions("place")
        .mapInArrow(lean(_train(bits, epochs, rates)), "at long, weight double")
        .toPandas()
    )
    weights = np.zeros((1 << bits) + 1)
    weights[learned["at"].to_numpy()] = learned["weight"].to_numpy()
    return weights


_RESULT = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]


def score(docs: DataFrame, weights: np.ndarray, with_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is more toxic) and ``predicted`` (0 or 1)."""
    bits = (len(weights) - 1).bit_length() - 1
    sent = docs.sparkSession.sparkContext.broadcast(
        (np.flatnonzero(weights), weights[np.flatnonzero(weights)], len(weights))
    )
    rest = docs.drop("score", "predicted")
    kept = [f for f in rest.schema if with_text or f.name != "text"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, size = sent.value
        dense = np.zeros(size)
        dense[at] = values
        known = dense[:-1] != 0
        for batch in batches:
            number, owner = terms(batch.column(batch.schema.get_field_index("text")), bits)
            counts = known[number]  # most terms have no weight
            numbers, first = distinct(number[counts], owner[counts], batch.num_rows, bits)
            total = np.concatenate([[0.0], np.cumsum(dense[numbers])])
            # Rounded, so that equal texts have equal scores wherever they stand in a batch.
            sums = np.round(total[first[1:]] - total[first[:-1]] + dense[-1], 9)
            scores = 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))
            columns = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    return rest.mapInArrow(lean(run), StructType(kept + _RESULT))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds. Null is the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))
