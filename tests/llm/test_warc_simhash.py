"""Archives and fingerprints: round trips and brute force."""

import base64
import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.llm import simhash as S
from vigil.llm.common import Scratch
from vigil.llm.warc import parse, read_archives, write_archives
from vigil.plans.scratch import scratch_path

PAGES = [
    (3, "http://a/", "<p>one</p>"),
    (1, "http://b/", "<p>one</p>"),
    (9, None, "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (4, "http://c/\r\nX: y", None),
    (5, "http://d/", ""),
    (6, "http://e/", "é漢\u0000" * 2000),
    (7, "http://e/", "é漢\u0000" * 2000),
    (None, "http://f/", "<p>one</p>"),
    (8, "http://g/", "z"), (8, "http://h/", "z"), (8, "http://i/", "y"),
]


def test_round_trip(spark):
    schema = "page_id long, url string, html string, record_type int"
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], schema)
    path = scratch_path(spark, "warc")
    write_archives(pages, path, file_bytes=4000)
    rows = read_archives(spark, path).collect()
    assert len(rows) == len(PAGES)
    got = sorted(((r.page_id, r.payload_digest), r) for r in rows if r.page_id not in (None, 8))
    for (page_id, url, text), (_, r) in zip(sorted(p for p in PAGES if p[0] not in (None, 8)), got):
        data = (text or "").encode()
        assert (r.page_id, r.payload_bytes) == (page_id, len(data))
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        equal = [p for p, _, t in PAGES if p is not None and (t or "") == (text or "")]
        first = min(equal)
        assert r.record_type == ("response" if page_id == first else "revisit")
        assert r.refers_to == (None if page_id == first else first)
        assert r.body == (data if page_id == first else b"")
    assert [r.record_type for r in rows if r.page_id in (None, 8)] == ["response"] * 4

    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes=100)
    kinds = {r.page_id: r.record_type for r in read_archives(spark, path, False).collect()}
    assert [k for k, v in kinds.items() if v == "revisit"] == [7]

    path = scratch_path(spark, "warc")
    write_archives(pages.limit(0), path)
    assert read_archives(spark, path).collect() == []


def test_parse_refuses_wrong_lengths():
    record = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabc\r\n\r\n"
    try:
        list(parse(record))
    except ValueError:
        return
    raise AssertionError("a wrong length must be refused")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 700), max_size=4), st.integers(0, 9))
def test_bit_counts(sizes, seed):
    hashes = np.random.default_rng(seed).integers(0, 2**63, sum(sizes), dtype=np.uint64)
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    got = S._ones(hashes, first)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    for i, (a, b) in enumerate(zip(first, first[1:])):
        assert got[i].tolist() == bits[a:b].sum(axis=0).tolist()


def test_equal_texts_equal_fingerprints():
    texts = ["a b c", None, "A B c", "", "one", "two", "x " * 2000]
    prints = S.fingerprints(pa.array(texts))
    assert (prints[0] == prints[2]).all() and (prints[1] == prints[3]).all()
    assert not prints[1].any() and (prints[4] != prints[5]).any()
    for i, text in enumerate(texts):
        assert (S.fingerprints(pa.array([text], pa.string()))[0] == prints[i]).all()


def test_near_fingerprints_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 256, (40, 32), dtype=np.uint8)
    rows = []
    for i in range(200):
        bits = np.unpackbits(base[i % 40])
        flip = rng.choice(256, rng.integers(0, 14), replace=False)
        bits[flip] ^= 1
        rows.append(np.packbits(bits).tobytes().hex())
    rows += rows[:5]
    prints = spark.createDataFrame([(r,) for r in rows], "fingerprint string")
    asked = spark.createDataFrame([(r,) for r in rows[::7]], "fingerprint string")
    for radius in (0, 3, 8, 12):
        got = {(r.query, r.fingerprint): (r.distance, r.n)
               for r in S.near_fingerprints(prints, asked, radius).collect()}
        want = {}
        for q in set(rows[::7]):
            for f in set(rows):
                d = bin(int(q, 16) ^ int(f, 16)).count("1")
                if d <= radius:
                    want[q, f] = (d, rows.count(f))
        assert got == want


def test_neighbours(spark):
    texts = {5: "abcdef ghi jkl", 9: "xyz", 2: None, 11: "é漢 long text of words " * 50, 7: ""}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, n_chars int")
    rows = {r.doc_id: r for r in S.compare_neighbours(docs).collect()}
    order = sorted(texts, reverse=True)
    for at, i in enumerate(order):
        mine, following = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        k = len(mine) // 3
        changed = mine[: len(mine) - k] + following[:k]
        assert rows[i].n_chars == len(mine)
        assert rows[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        prints = S.fingerprints(pa.array([mine, changed, following]))
        assert rows[i].fingerprint == prints[0].tobytes().hex()
        assert rows[i].edited_fingerprint == prints[1].tobytes().hex()
        assert rows[i].near_edited == S.likeness(prints[:1], prints[1:2])[0]
        assert rows[i].near_next == S.likeness(prints[:1], prints[2:])[0]
    one = docs.filter("doc_id = 9")
    assert S.compare_neighbours(one).first().near_next == 1.0
    assert S.compare_neighbours(docs.limit(0)).collect() == []
    odd = docs.unionByName(docs).unionByName(docs.selectExpr("null doc_id", "text", "1 n_chars"))
    assert S.compare_neighbours(odd.selectExpr("cast(doc_id as long) doc_id", "text")).count() == 15


def test_near_copies_are_found_and_named(spark):
    """Near copies of five-word Jaccard from 0.8 to below 1 are found by their ids."""
    rng = np.random.default_rng(3)
    stock = ["w" + "".join(rng.choice(list("abcdefgh"), 5)) for _ in range(3000)]
    texts, near = {}, []
    for i in range(30):
        words = list(rng.choice(stock, 300))
        texts[20 * i] = " ".join(words)
        for at in (50, 150, 250):
            words[at] = f"edited{i}"
        texts[20 * i + 1] = texts[20 * i + 2] = " ".join(words)
        near.append((texts[20 * i], texts[20 * i + 1]))
    texts[601] = texts[0]

    def runs(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    for a, b in near:
        assert 0.8 <= len(runs(a) & runs(b)) / len(runs(a) | runs(b)) < 1
    rows = [(i, t, 1) for i, t in texts.items()] + [(None, texts[0], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    scratch = Scratch(spark)
    compared = scratch.put(S.compare_neighbours(docs), "fingerprints")
    got = {r.doc_id: r for r in S.name_near(compared, F.col("doc_id") % 20 == 0, scratch).collect()}
    assert len(got) == len(rows)
    for i in range(30):
        row = got[20 * i]
        assert [(n.representative, n.n) for n in row.near] == [(20 * i + 1, 2)]
        assert 0 < row.near[0].distance <= S.RADIUS
        assert row.n_near == (4 if i == 0 else 2)
        assert got[20 * i + 2].representative == 20 * i + 1
        assert got[20 * i + 2].n_near is None and got[20 * i + 2].near is None
    assert got[601].representative == got[None].representative == 0


def test_wide_radius_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (10, 32), dtype=np.uint8)
    rows = []
    for i in range(120):
        bits = np.unpackbits(base[i % 10])
        bits[rng.choice(256, rng.integers(0, 34), replace=False)] ^= 1
        rows.append(np.packbits(bits).tobytes().hex())
    prints = spark.createDataFrame([(r,) for r in rows], "fingerprint string")
    for radius in (13, 27, 31):
        got = sorted((r.query, r.fingerprint, r.distance)
                     for r in S.near_fingerprints(prints, prints, radius).collect())
        apart = lambda q, f: bin(int(q, 16) ^ int(f, 16)).count("1")
        want = sorted((q, f, apart(q, f)) for q in set(rows) for f in set(rows) if apart(q, f) <= radius)
        assert got == want
