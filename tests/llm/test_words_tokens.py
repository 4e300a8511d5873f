"""Vectorised words and part-wise token ids against plain Python and the whole tokenizer."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import tokens as K
from vigil.llm import words as W
from vigil.llm.tokens import PartTokenizer

TEXTS = st.lists(
    st.one_of(st.none(), st.text(alphabet="abAB0 \t\n\r\x0b\x0c.é漢 ", max_size=40)),
    max_size=6,
)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_split_equals_regular_expression(texts, piece):
    before, W.PIECE_BYTES = W.PIECE_BYTES, piece
    try:
        plain = W.split(pa.array(texts, pa.string()))
        lowered = W.split(pa.array(texts, pa.string()), W.PUNCTUATION, lower=True)
    finally:
        W.PIECE_BYTES = before
    for i, text in enumerate(texts):
        data = (text or "").encode()
        want = re.findall(rb"[^\x20\x09-\x0D]+", data)
        assert plain.words(i, 0, 100) == want
        assert W.joined(plain, i) == b" ".join(want)
        lower = data.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
        want = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        assert lowered.words(i, 0, 100) == want


@settings(max_examples=50, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    found = W.split(pa.array(texts, pa.string()))
    said = [w for i in range(len(texts)) for w in found.words(i, 0, 100)]
    by_word = {}
    for word, hash_ in zip(said, found.hash.tolist()):
        assert by_word.setdefault(word, hash_) == hash_
    assert len(set(by_word.values())) == len(by_word)


def test_sliced_columns_and_runs():
    column = pa.array(["x y", "a b c d", None, "b c", ""]).slice(1, 4)
    found = W.split(column)
    hashes, inside = W.runs(found, 2)
    assert inside.tolist() == [True, True, True, False, True, False]
    assert hashes[1] == hashes[4] and hashes[0] != hashes[1]
    keep = np.array([True, False, False, True])
    assert W.joined(found, 0, keep) == b"a d"


@pytest.fixture(scope="module")
def tokenizer():
    return PartTokenizer()


@settings(max_examples=60, deadline=None)
@given(
    st.lists(
        st.text(alphabet="aAzE.,!'-09 \n\t<|>éÉß$%&#*_\\/[]^~`İıŉſΣ´×—́　", max_size=60),
        max_size=5,
    )
)
def test_parts_equal_the_whole(tokenizer, texts):
    assert tokenizer.by_parts
    whole = tokenizer.whole.encode_batch(texts, add_special_tokens=False)
    packed = tokenizer.pack(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [e.ids for e in whole]


def test_special_strings_null_and_long(tokenizer):
    texts = ["a<|endoftext|>b <|startoftext|>", None, "", "x" * 5000, "don't I'll 'S"]
    packed = tokenizer.pack(texts)
    whole = tokenizer.whole.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [e.ids for e in whole]
    assert 49407 in whole[0].ids
    plain = PartTokenizer(plain=True).pack(texts)
    assert 49407 not in np.frombuffer(plain[0], "<u4")


def thue_morse(size):
    """Two different words whose polynomial hashes modulo 2^64 are equal, whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [512, 1024, 2048, 4096])
def test_hashes_of_thue_morse_strings_differ(size):
    one, other = thue_morse(size)
    found = W.split(pa.array([one, other, " ".join(one), " ".join(other)]))
    assert found.hash[0] != found.hash[1]
    hashes, inside = W.runs(found, size)
    assert inside.sum() == 2 and len(set(hashes[inside].tolist())) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 20))
def test_runs_are_equal_where_the_words_are(words, n):
    found = W.split(pa.array([" ".join(words)]))
    hashes, inside = W.runs(found, n)
    seen = {}
    for i in np.flatnonzero(inside):
        seen.setdefault(tuple(words[i : i + n]), set()).add(int(hashes[i]))
    assert all(len(s) == 1 for s in seen.values())
    assert len(set().union(*seen.values())) == len(seen)


def test_cache_is_bounded_in_bytes():
    small = PartTokenizer(cache_bytes=40_000)
    large = PartTokenizer()
    for turn in range(30):
        texts = [" ".join(f"word{'x' * (i % 7)}{chr(97 + (i * turn) % 26)}" for i in range(60))] * 3
        texts.append("common words " + "z" * turn)
        assert small.pack(texts) == large.pack(texts)
        for part in (small.young, small.old):
            held = sum(len(k) + len(v) + 240 for k, v in part.items())
            assert held <= 20_000
    assert small.old and "common" in small.young | small.old


def junk(seed, n):
    letters = np.random.default_rng(seed).integers(97, 123, (n, 9)).astype(np.uint8)
    return [bytes(word).decode() for word in letters]


def test_words_met_once_do_not_drive_out_others():
    """Words of every sixth batch, junk in all: each is encoded a few times, not once a batch."""
    tokenizer = PartTokenizer(cache_bytes=60_000)
    rare = [f"rare{chr(97 + i)}" for i in range(10)]
    encoded, parts = [], tokenizer._parts
    tokenizer._parts = lambda new: encoded.extend(new) or parts(new)
    for turn in range(60):
        tokenizer.pack([" ".join(junk(turn, 60) + (rare if turn % 6 == 0 else []))])
    assert len(set(encoded) - set(rare)) >= 3600 - 2
    assert sum(part in rare for part in encoded) <= 5 * len(rare)  # ten turns have them


def test_plain_bytes_are_plain_letters():
    """Every character below U+3000: the bytes say what the expression over characters says."""
    chars = [chr(c) for c in range(0x3000)]
    odd = K.not_plain(pa.array(chars)).tolist()
    assert odd == [K._NOT_PLAIN.search(c) is not None for c in chars]
    texts = [f"A{c}b1{c}{c} {c}Z" for c, is_odd in zip(chars, odd) if not is_odd]
    parts, first = K.plain_parts(pa.array(texts))
    parts = parts.to_pylist()
    found = [parts[a:b] for a, b in zip(first, first[1:])]
    assert found == [K._PART.findall(text.lower()) for text in texts]


def test_columns_with_slices_nulls_and_odd_texts(tokenizer):
    texts = ["cut off", "Äb1 c", None, "", "don't", " \n", "a<", "|b", "Äb22 C!?", "K ﬁ", None]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        for low, high in ((0, 11), (1, 9), (2, 4), (4, 5), (5, 5), (6, 11)):
            whole = tokenizer.whole.encode_batch(
                [t or "" for t in texts[low:high]], add_special_tokens=False
            )
            packed = tokenizer.pack(column.slice(low, high - low))
            assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [e.ids for e in whole]


def test_failed_batch_leaves_no_wrong_ids():
    tokenizer = PartTokenizer()
    parts, tokenizer._parts = tokenizer._parts, lambda new: 1 / 0
    with pytest.raises(ZeroDivisionError):
        tokenizer.pack(["some words"])
    tokenizer._parts = parts
    assert tokenizer.pack(["some words"]) == PartTokenizer().pack(["some words"])
