"""Best-fit packing of documents into token sequences, with certified bin counts.

Documents become pieces of at most ``size`` tokens; from there on only lengths travel. Pieces
are dealt into buckets by hash. Each bucket is packed best-fit decreasing and compared with
lower bounds from dual-feasible functions; where the bin count equals the bound, no packing of
the bucket is better. A bucket with a gap gives back the pieces of all bins that are not full,
a certified one those of its emptiest bin (so that what is left over meets once more). The
pieces given back are dealt anew over fewer buckets and packed again, until one bucket holds
them or ``rounds`` are over.

Defined cases: a null text is empty, an empty document is its end token alone; rows that repeat
an id are packed one by one; an empty table gives no sequences; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import Scratch, lean
from vigil.llm.tokens import shared

SEQUENCE = 4096
BUCKET = 20_000
ROUNDS = 4

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = f"{_PIECES}, sequence_id long, offset long"


def cut(packed: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Piece, start, length and checksum of a document's packed ids (four bytes each)."""
    view = memoryview(packed)
    for piece, at in enumerate(range(0, len(packed), 4 * size)):
        part = view[at : at + 4 * size]
        yield piece, at // 4, len(part) // 4, zlib.crc32(part)


def _pieces(size: int, end_id: int, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = tokenizer.pack(batch.column(1))
            for doc_id, packed in zip(batch.column(0).to_pylist(), texts):
                rows += [(doc_id, *piece) for piece in cut(packed + end, size)]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(
    docs: DataFrame, size: int = SEQUENCE, end_id: int = 1, tokenizer: str | None = None
) -> DataFrame:
    """Pieces of the documents' ids followed by ``end_id``; longer ones are cut at ``size``."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lean(_pieces(size, end_id, tokenizer)), _PIECES)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each length, and the room left in each bin."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    room: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    open_rooms = 0  # bit r is set while a bin with room r exists
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = open_rooms >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            target = by_room[left].pop()
            if not by_room[left]:
                open_rooms &= ~(1 << left)
        else:
            left, target = size, len(room)
            room.append(size)
        bins[i], offsets[i] = target, size - left
        left -= length
        room[target] = left
        if left:
            by_room[left].append(target)
            open_rooms |= 1 << left
    return bins, offsets, np.array(room, dtype=np.int64)


def lower_bound(lengths: np.ndarray, size: int, ks: int = 16) -> int:
    """No packing has fewer bins: the best of two families of dual-feasible functions.

    The first keeps what is over size - a whole, drops what is under a and counts the rest by
    length, for every a up to half; the second rounds (k + 1) * length / size down.
    """
    if len(lengths) == 0:
        return 0
    counts = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    values = np.arange(size + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * values)
    half = size // 2
    a = np.arange(half + 1)
    big = number[size] - number[size - a]
    between = number[size - a] - number[half]
    between_total = total[size - a] - total[half]
    under = total[half] - np.where(a > 0, total[np.maximum(a - 1, 0)], 0)
    rest = under - (between * size - between_total)
    best = int(np.max(big + between + np.maximum(0, -(-rest // size))))
    for k in range(1, ks + 1):
        scaled = (k + 1) * values
        exact = scaled % size == 0
        # In units of 1 / (k * size), so that no fraction is rounded.
        weight = np.where(exact, values * k, scaled // size * size)
        best = max(best, -(-int((counts * weight).sum()) // (k * size)))
    return best


def _pack(size: int, round_: int, last: bool):
    order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order).drop_columns("bucket")
        lengths = rows.column("length").to_numpy()
        bins, offsets, room = best_fit(lengths, size)
        given_back = np.zeros(len(room), dtype=bool)
        if not last:
            if len(room) > lower_bound(lengths, size):
                given_back = room > 0
            elif room.max() > 0:
                given_back[room.argmax()] = True
        sequence = (round_ << 48) + (key[0].as_py() << 24) + bins
        sequence = np.where(given_back[bins], -1, sequence)
        return rows.append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offsets)
        )

    return run


def pack(
    cut_up: DataFrame,
    scratch: Scratch,
    size: int = SEQUENCE,
    bucket: int = BUCKET,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: sequences of at most ``size`` tokens, filled
    without gaps from 0."""
    waiting = scratch.put(cut_up, "pieces")
    done = None
    for round_ in range(rounds):
        buckets = -(-waiting.count() // bucket)
        last = buckets <= 1 or round_ == rounds - 1
        key = F.pmod(F.xxhash64("doc_id", "piece", F.lit(round_)), F.lit(max(1, buckets)))
        placed = (
            waiting.withColumn("bucket", key)
            .groupBy("bucket")
            .applyInArrow(_pack(size, round_, last), _PLACED)
        )
        placed = scratch.put(placed, f"round{round_}")
        final = placed if last else placed.filter("sequence_id >= 0")
        done = final if done is None else done.unionByName(final)
        if last:
            break
        waiting = placed.filter("sequence_id < 0").drop("sequence_id", "offset")
    return done


def pack_documents(
    docs: DataFrame, size: int = SEQUENCE, end_id: int = 1, tokenizer: str | None = None
) -> DataFrame:
    """All documents packed: one row per piece, with its sequence and place there."""
    return pack(pieces(docs, size, end_id, tokenizer), Scratch(docs.sparkSession), size)
