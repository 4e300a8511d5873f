"""Components of near-duplicates against brute force over all pairs."""

import numpy as np
import pytest

from vigil.llm.common import Scratch
from vigil.llm.neardup import components, drop_near_duplicates, near_duplicates


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, k, percent=80):
    sets = {i: shingle_set(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, base, copies, rate):
    out = []
    for _ in range(copies):
        words = [w if rng.random() > rate else f"n{rng.integers(1000)}" for w in base]
        out.append(" ".join(words))
    return out


def corpus(seed=3):
    rng = np.random.default_rng(seed)
    texts = ["", None, "   ", "one", "One", "one two", "two one", "x " * 3000]
    for size, rate in ((80, 0.02), (60, 0.05), (100, 0.1), (12, 0.08)):
        base = [f"w{x}" for x in rng.integers(0, 400, size)]
        texts += family(rng, base, 25, rate)
    common = [f"c{i}" for i in range(40)]
    for _ in range(20):  # a passage shared by otherwise different texts
        texts.append(" ".join(common + [f"r{x}" for x in rng.integers(0, 9000, 30)]))
    texts += texts[10:14]
    order = rng.permutation(len(texts))
    return [(int(i) * 7, texts[j]) for i, j in enumerate(order)]


@pytest.mark.parametrize("k", [2, 5])
def test_equals_brute_force(spark, k):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, shingle=k).collect()
    want = brute(rows, k)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_defined_cases(spark):
    schema = "doc_id long, text string, n long, component int, row long"
    empty = spark.createDataFrame([], schema)
    assert near_duplicates(empty).collect() == []
    rows = [(None, "a b c", 1, 2, 3), (5, "a b c", 1, 2, 3), (5, "A b c", 1, 2, 3),
            (4, None, 1, 2, 3), (3, "other text", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    got = near_duplicates(docs, shingle=2).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 3
    assert {r.component_id for r in got if r.doc_id == 5} == {None}
    kept = drop_near_duplicates(docs, shingle=2)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "None"]


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, Scratch(spark), "t").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 150: 100}


def test_words_of_thue_morse_are_not_one(spark):
    from tests.llm.test_words_tokens import thue_morse

    rows = [(i, word) for i, word in enumerate(thue_morse(1024) + thue_morse(2048))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, shingle=2).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i for i in range(4)}
