"""Repeated spans against a brute-force search."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm.queries import ORACLE  # noqa: F401
from vigil.llm.substring import SuffixAutomaton, strip_reference, strip_repeats

LETTERS = st.lists(st.sampled_from("abc"), max_size=12)


def longest_suffix(words, end, texts):
    best = 0
    for n in range(1, end + 1):
        part = words[end - n : end]
        if any(part == t[i : i + n] for t in texts for i in range(len(t) - n + 1)):
            best = n
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(LETTERS, min_size=1, max_size=4), LETTERS)
def test_matching_statistics(texts, words):
    automaton = SuffixAutomaton()
    for text in texts:
        automaton.add(text)
    want = [longest_suffix(words, end, texts) for end in range(1, len(words) + 1)]
    assert automaton.match(words) == want


def brute(texts, n):
    seen, out = set(), []
    for text in texts:
        words = (text or "").split()
        gone = [False] * len(words)
        for i in range(len(words) - n + 1):
            window = tuple(words[i : i + n])
            if window in seen:
                gone[i : i + n] = [True] * n
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), sum(gone), kept))
    return out


def texts_with_repeats(seed, size=60):
    rng = np.random.default_rng(seed)
    passages = [[f"p{k}w{i}" for i in range(rng.integers(5, 40))] for k in range(6)]
    texts = []
    for _ in range(size):
        words = []
        for _ in range(rng.integers(0, 5)):
            if rng.random() < 0.5:
                passage = passages[int(rng.integers(6))]
                a = int(rng.integers(0, 4))
                words += passage[a : len(passage) - int(rng.integers(0, 4))]
            else:
                words += [f"w{x}" for x in rng.integers(0, 12, int(rng.integers(1, 12)))]
        texts.append(" ".join(words))
    return [*texts, None, "", " \n ", "z " * 5000, texts[3], texts[3]]


@pytest.mark.parametrize("n,hot", [(3, 4096), (5, 2), (12, 3)])
def test_repeats_equal_brute_force(spark, n, hot):
    texts = texts_with_repeats(n)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = strip_repeats(docs.repartition(5), min_words=n, hot=hot).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in got] == brute(texts, n)


def test_defined_cases(spark):
    schema = "doc_id long, text string, kept int, start string, row long, windows long"
    empty = spark.createDataFrame([], schema)
    assert strip_repeats(empty).collect() == []
    rows = [(None, "a b c d", 1, "s", 2, 3), (7, "a b c d", 1, "s", 2, 3),
            (7, "a b c d", None, None, None, None), (7, None, 1, "s", 2, 3)]
    got = strip_repeats(spark.createDataFrame(rows, schema), min_words=3).collect()
    assert len(got) == 4
    # Null ids come first, then equal ids by text: one of three equal texts keeps its words.
    assert sorted(r.n_removed for r in got) == [0, 0, 4, 4]
    assert next(r for r in got if r.doc_id is None).n_removed == 0
    assert got[0].start in ("s", None) and "windows" in got[0].asDict()


def test_reference(spark):
    reference = spark.createDataFrame([("one two three four five",), (None,)], "text string")
    texts = ["x one two three y", "two three four five one two", "one two", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for shard_words in (200_000, 1):
        got = strip_reference(docs, reference, min_words=3, shard_words=shard_words)
        kept = {r.doc_id: (r.n_removed, r.kept) for r in got.collect()}
        assert kept == {0: (3, "x y"), 1: (4, "one two"), 2: (0, "one two"), 3: (0, "")}
    with pytest.raises(ValueError):
        strip_reference(docs, reference, reference_words=1)


def test_words_of_thue_morse_are_kept(spark):
    from tests.llm.test_words_tokens import thue_morse

    common = " ".join(f"w{i}" for i in range(24))
    rows = [(i + 1, f"{common} {word}") for i, word in enumerate(thue_morse(1024))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in strip_repeats(docs, min_words=20).collect()}
    assert got == {1: 0, 2: 24}
