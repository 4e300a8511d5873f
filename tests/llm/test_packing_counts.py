"""Packing and token counts: bounds, round trips, brute force."""

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import tokencount as T
from vigil.llm.common import Scratch
from vigil.llm.packing import best_fit, lower_bound, pack, pack_documents, pieces
from vigil.llm.tokens import PartTokenizer
from vigil.plans.scratch import scratch_path


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_is_valid_and_bounded(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    bins, offsets, room = best_fit(lengths, 20)
    filled = defaultdict(list)
    for b, o, n in zip(bins, offsets, lengths):
        filled[b].append((o, n))
    for b, placed in filled.items():
        at = 0
        for o, n in sorted(placed):
            assert o == at
            at += n
        assert at + room[b] == 20
    assert lower_bound(lengths, 20) <= len(room)


def fewest(lengths, size):
    for n in range(1, len(lengths) + 1):
        for assigned in itertools.product(range(n), repeat=len(lengths)):
            if all(
                sum(x for x, b in zip(lengths, assigned) if b == k) <= size for k in range(n)
            ):
                return n
    return 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=6))
def test_bound_never_exceeds_the_optimum(lengths):
    assert lower_bound(np.array(lengths, dtype=np.int64), 9) <= fewest(lengths, 9)
    assert lower_bound(np.array([5, 5, 5]), 9) == 3  # more than the sum says


TEXTS = ["one two three", None, "", "word " * 5000, "a", "b c", "b c", "x" * 3000]


def test_pieces_round_trip(spark):
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "a", "x", 1), (5, "b c", "x", 1)],
        "doc_id long, text string, length string, piece long",
    )
    rows = pack_documents(docs, size=64).collect()
    ids = {i: np.frombuffer(p, "<u4").tolist() + [1] for i, p in
           enumerate(PartTokenizer().pack(TEXTS))}
    by_doc = defaultdict(list)
    by_sequence = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, want in ids.items():
        found = sorted(by_doc[doc], key=lambda r: r.piece)
        if doc == 5:
            found = found[:1]
        assert [r.start for r in found] == list(range(0, len(want), 64))
        for r in found:
            part = np.array(want[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part) and len(part) == 4 * r.length
    assert len(by_doc[None]) == 1 and len(by_doc[5]) == 2
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    assert pack_documents(docs.limit(0)).collect() == []


def test_exchange_between_buckets(spark):
    rng = np.random.default_rng(0)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(rng.integers(1, 60, 3000))]
    cut_up = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    placed = pack(cut_up, Scratch(spark), size=100, bucket=100).collect()
    assert Counter(r.doc_id for r in placed) == Counter(range(3000))
    used = Counter()
    for r in placed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 100
    least = lower_bound(np.array([r[3] for r in rows]), 100)
    alone = len(best_fit(np.array([r[3] for r in rows]), 100)[2])
    assert least <= len(used) <= 1.01 * alone


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30))
def test_scan_block(ids):
    ends, head, tail, inner = T.scan_block(np.array(ids, dtype=np.uint16), 0)
    parts, part = [], 0
    for i in ids:
        if i == 0:
            parts.append(part)
            part = 0
        else:
            part += 1
    if ends:
        assert (head, tail, list(inner)) == (parts[0], part, parts[1:]) and ends == len(parts)
    else:
        assert head == tail == len(ids)


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_counts_of_files(spark, block):
    texts = ["one two three", None, "", "<|endoftext|> spelled out", "word " * 300, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "file long, text string")
    path = scratch_path(spark, "tokens")
    T.write_tokens(docs.coalesce(2), path, rows_per_file=2)
    got = T.stitch(T.scan_files(spark, path, block_tokens=block)).collect()
    packed = PartTokenizer(dtype="<u2", plain=True).pack(texts)
    assert Counter(r.n_tokens for r in got) == Counter(len(p) // 2 for p in packed)
    for file in {r.file for r in got}:
        at = 0
        for n, r in enumerate(sorted((r for r in got if r.file == file), key=lambda r: r.document)):
            assert (r.document, r.start) == (n, at)
            at += r.n_tokens + 1


def test_open_end_and_empty(spark):
    schema = T._BLOCKS
    rows = []
    for block, ids in enumerate(([5, 0, 5], [5, 5], [0, 0, 5])):
        ends, head, tail, inner = T.scan_block(np.array(ids), 0)
        rows.append(("f", block, len(ids), ends, head, tail, [int(x) for x in inner]))
    got = T.stitch(spark.createDataFrame(rows, schema)).orderBy("document").collect()
    assert [(r.start, r.n_tokens) for r in got] == [(0, 1), (2, 3), (6, 0), (7, 1)]
    assert T.stitch(spark.createDataFrame([], schema)).collect() == []


def test_pieces_of_a_batch_schema(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert pieces(empty).collect() == []
    assert pa.array([], pa.int64()).type == pa.int64()
