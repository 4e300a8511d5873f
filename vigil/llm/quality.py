"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's features describe its characters and
words, and those of the lines before and after it; the chain adds weights for the change of
label between neighbours. Forward-backward gives each line's probability of being good; their
mean, weighted by line length, is the quality of the document, mapped to a probability by a
logistic curve.

Labels exist for documents only; each line of a labelled document is taught the document's
label. The field is fitted in one task on a bounded sample: the ``sample`` labelled rows of
least hash (a parameter). The sample's ids are broadcast; only line features of it travel.

Defined cases: a null text is empty, an empty text is one empty line; null labels are not
learned from; a document labelled twice counts as 0 if any label is 0; without labelled rows
every score is 0.5; rows that repeat an id are scored one by one; input columns named ``score``
or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from vigil.llm.common import lean
from vigil.llm.words import column_bytes, split

SAMPLE = 6000
STEPS = 200

_CLASSES = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "stop": b".,;:?'\"-()",
    "bang": b"!",
    "bar": b"|",
    "mark": b"*#$%&@^~=+<>/\\_`{}[]",
    "other": range(0x80, 0x100),
}
_CLASS = np.full(256, len(_CLASSES), dtype=np.uint8)
for _number, _bytes in enumerate(_CLASSES.values()):
    _CLASS[list(_bytes)] = _number

OWN = len(_CLASSES) + 7
WIDTH = 3 * OWN + 1


@dataclass
class Lines:
    """``first[i]:first[i + 1]`` are the lines of text i, with their features and lengths."""

    first: np.ndarray
    features: np.ndarray
    length: np.ndarray


def lines(column: pa.Array) -> Lines:
    """Features of every line of the texts. Texts end lines with a line feed only."""
    data, offsets = column_bytes(column)
    breaks = np.flatnonzero(data == 0x0A)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    text = np.concatenate([np.arange(len(offsets) - 1), owner])
    start = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    first = np.searchsorted(text, np.arange(len(offsets)))
    end = np.concatenate([start[1:] - 1, [offsets[-1]]])
    last = first[1:] - 1
    end[last] = offsets[1:]
    size = end - start
    scale = 1.0 / np.maximum(size, 1)

    kind = _CLASS[data]
    columns = []
    for number in range(len(_CLASSES)):
        running = np.concatenate([[0], np.cumsum(kind == number, dtype=np.int64)])
        columns.append((running[end] - running[start]) * scale)

    words = split(column)
    low = np.searchsorted(words.start, start)
    high = np.searchsorted(words.start, end)
    count = high - low
    per_word = 1.0 / np.maximum(count, 1)
    again = np.zeros(len(words.hash) + 1, dtype=np.int64)
    if len(words.hash) > 1:
        again[2:] = np.cumsum(words.hash[1:] == words.hash[:-1])
    alpha = np.zeros(len(words.hash) + 1, dtype=np.int64)
    if len(words.hash):
        ends = kind[words.end - 1]
        alpha[1:] = np.cumsum((ends >= 4) & (ends <= 6))
    columns += [
        np.maximum(again[high] - again[np.minimum(low + 1, high)], 0) * per_word,
        (alpha[high] - alpha[low]) * per_word,
        np.minimum(count * scale * 4, 2.0),
        np.log1p(size) / 8.0,
        np.log1p(count) / 8.0,
        (size == 0).astype(float),
        (count <= 2).astype(float),
    ]
    own = np.stack(columns, axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0.0
    after[last] = 0.0
    one = np.ones((len(own), 1))
    return Lines(first, np.hstack([own, before, after, one]), size + 1.0)


def forward_backward(
    first: np.ndarray, unary: np.ndarray, change: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of chains of two states.

    ``unary`` are the scores of each place, ``change`` the scores of state pairs. Returns the
    probability of state 1 at each place, and of each pair of states at a place and the next
    (zero at the last place of a chain).
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(longest + 1)]
    local = np.exp(unary - unary.max(axis=1, keepdims=True))
    move = np.exp(change - change.max())
    ahead = np.empty_like(local)
    behind = np.ones_like(local)
    for t in range(longest):
        at = begin[: active[t]] + t
        here = local[at] if t == 0 else (ahead[at - 1] @ move) * local[at]
        ahead[at] = here / here.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        back = (behind[at + 1] * local[at + 1]) @ move.T
        behind[at] = back / back.sum(axis=1, keepdims=True)
    both = ahead * behind
    ones = both[:, 1] / both.sum(axis=1)
    pairs = np.zeros((len(unary), 2, 2))
    inner = np.ones(len(unary), dtype=bool)
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    pair = ahead[at][:, :, None] * move[None] * (local[at + 1] * behind[at + 1])[:, None, :]
    pairs[at] = pair / pair.sum(axis=(1, 2), keepdims=True)
    return ones, pairs


@dataclass
class Field:
    """Weights of the field: of a line's features for "good", of label pairs, and of the curve
    that maps a document's weighted mean to a probability."""

    weights: np.ndarray
    change: np.ndarray
    curve: tuple[float, float] = (0.0, 0.0)

    def marginals(self, found: Lines) -> tuple[np.ndarray, np.ndarray]:
        good = found.features @ self.weights
        return forward_backward(found.first, np.stack([0 * good, good], 1), self.change)

    def means(self, found: Lines) -> np.ndarray:
        """Length-weighted mean probability of good lines, per text."""
        good, _ = self.marginals(found)
        total = np.add.reduceat(good * found.length, found.first[:-1])
        return total / np.add.reduceat(found.length, found.first[:-1])

    def scores(self, found: Lines) -> np.ndarray:
        if len(found.first) < 2:
            return np.zeros(0)
        slope, level = self.curve
        return _sigmoid(slope * _logit(self.means(found)) + level)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.m, self.v = rate, 0, 0.0, 0.0

    def __call__(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        m, v = self.m / (1 - 0.9**self.step), self.v / (1 - 0.999**self.step)
        return self.rate * m / (np.sqrt(v) + 1e-8)


def train(found: Lines, labels: np.ndarray, steps: int = STEPS, l2: float = 1e-4) -> Field:
    """Maximum likelihood with every text weighing the same."""
    field = Field(np.zeros(found.features.shape[1]), np.zeros((2, 2)))
    if len(labels) == 0:
        return field
    sizes = np.diff(found.first)
    taught = np.repeat(labels, sizes).astype(float)
    weight = np.repeat(1.0 / sizes, sizes) / len(labels)
    inner = np.ones(len(taught), dtype=bool)
    inner[found.first[1:] - 1] = False
    own = np.zeros((2, 2))
    for state in (0, 1):  # neighbours share the label of their text
        own[state, state] = weight[inner & (taught == state)].sum()
    unary_step, change_step = _Adam(0.1), _Adam(0.05)
    for _ in range(steps):
        good, pairs = field.marginals(found)
        slope = found.features.T @ (weight * (good - taught)) + l2 * field.weights
        moved = (pairs * weight[:, None, None]).sum(axis=0) - own + 1e-2 * field.change
        field.weights = field.weights - unary_step(slope)
        field.change = field.change - change_step(moved)
    x = np.stack([_logit(field.means(found)), np.ones(len(labels))], 1)
    curve = np.zeros(2)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = _sigmoid(x @ curve)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        curve += np.linalg.solve(hessian, x.T @ (labels - p) - curve)
    field.curve = (float(curve[0]), float(curve[1]))
    return field


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = lines(batch.column(0))
        packed = [
            (found.features[a:b].astype(np.float32).tobytes(), found.length[a:b].tobytes())
            for a, b in zip(found.first, found.first[1:])
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in packed], pa.binary()),
                pa.array([p[1] for p in packed], pa.binary()),
                batch.column(1),
                batch.column(2),
            ],
            names=["features", "length", "label", "place"],
        )


def _train(steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, lengths, labels = [], [], []
        for batch in batches:
            for feature, length, label in zip(*(c.to_pylist() for c in batch.columns[:3])):
                features.append(np.frombuffer(feature, np.float32).reshape(-1, WIDTH))
                lengths.append(np.frombuffer(length))
                labels.append(label)
        first = np.concatenate([[0], np.cumsum([len(x) for x in lengths])]).astype(np.int64)
        field = Field(np.zeros(WIDTH), np.zeros((2, 2)))
        if labels:
            found = Lines(first, np.vstack(features).astype(float), np.concatenate(lengths))
            field = train(found, np.array(labels), steps)
        values = [*field.weights, *field.change.ravel(), *field.curve]
        yield pa.RecordBatch.from_arrays([pa.array([values])], names=["values"])

    return run


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, steps: int = STEPS
) -> Field:
    """The field learned from ``labels`` (doc_id, label) of ``docs``."""
    known = labels.filter("doc_id is not null and label is not null")
    known = known.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = chosen.select("text", "label", F.xxhash64("doc_id", "text").alias("place"))
    learned = (
        rows.mapInArrow(lean(_extract), "features binary, length binary, label int, place long")
        .repartition(1)
        .sortWithinPartitions("place")
        .mapInArrow(lean(_train(steps)), "values array<double>")
        .collect()
    )
    values = np.array(learned[0]["values"]) if learned else np.zeros(WIDTH + 6)
    change = values[WIDTH : WIDTH + 4].reshape(2, 2)
    return Field(values[:WIDTH], change, (float(values[-2]), float(values[-1])))


_RESULT = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]


def score(docs: DataFrame, field: Field, with_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (0 or 1)."""
    rest = docs.drop("score", "predicted")
    kept = [f for f in rest.schema if with_text or f.name != "text"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            # Rounded, so that equal texts have equal scores wherever they stand in a batch.
            scores = np.round(field.scores(lines(texts)), 9)
            columns = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    return rest.mapInArrow(lean(run), StructType(kept + _RESULT))
