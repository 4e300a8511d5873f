"""Token ids of whole texts, part by part.

The tokenizer used here lower-cases, drops white space and encodes the parts between (runs of
letters, single digits, runs of other signs) separately, so the ids of a text are those of its
parts, one after the other. Texts are cut on the bytes of their Arrow column and parts that are
equal are found there; Python sees each different part of a batch once, and the ids of the texts
are one ``take``. Parts repeat over batches, too: their ids are kept as packed bytes in a cache of
two generations bounded in bytes. New parts are encoded together by the tokenizer's model. Most of
them never come again, so once the cache has been full, a part enters it only when a second batch
has it. Words with characters whose treatment is not plain (see ``_PLAIN``) go through the whole
tokenizer. A tokenizer file of another make is used as it is, text by text.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vigil.llm.words import column_bytes

DEFAULT = "word_bpe_49k.json"
CACHE_BYTES = 64 << 20
MARK_SHARE = 40  # bytes of the cache for one mark
PART_BYTES = 240  # of a cached part beside its letters and ids: two objects and their entry

# Letters whose lower case is one letter and which no normalisation changes.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž"
_SIGNS = r"!-&(-/:-@\[-`{-~"
_SPACES = " \t\n\r\x0b\x0c"
_NOT_PLAIN = re.compile(f"[^{_LETTERS}0-9{_SIGNS}{_SPACES}]|<\\|")
_PART = re.compile(f"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")
_OTHER_SPACES = str.maketrans({c: " " for c in _SPACES})

# The same by bytes: the two of a letter beyond ASCII (U+00C0 to U+017F) count as letters, but for
# some pairs.
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, dtype=np.uint8)
_KIND[list(_SPACES.encode())] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[[b for b in range(128) if re.fullmatch(f"[{_SIGNS}]", chr(b))]] = _SIGN
_ODD_PAIRS = [tuple(pair.encode()) for pair in ("×", "÷", "İ", "ŉ", "ſ", "<|")]

# The parts of a tokenizer file that the encoding by parts relies on.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SUFFIX = "</w>"


def default_path() -> str:
    """Path of the default public tokenizer on this machine."""
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


def _by_parts(path: str) -> dict | None:
    """The vocabulary, if the file describes a tokenizer that works part by part."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    try:
        normalizers = [n["type"] for n in described["normalizer"]["normalizers"]]
        split, bytes_ = described["pre_tokenizer"]["pretokenizers"]
        fits = (
            normalizers == _NORMALIZERS
            and split["pattern"] == {"Regex": _PATTERN}
            and (split["behavior"], split["invert"]) == ("Removed", True)
            and (bytes_["type"], bytes_["use_regex"]) == ("ByteLevel", False)
            and not bytes_["add_prefix_space"]
            and described["model"]["type"] == "BPE"
            and described["model"]["end_of_word_suffix"] == _SUFFIX
        )
    except (KeyError, TypeError, ValueError):
        return None
    return described["model"]["vocab"] if fits else None


def not_plain(column: pa.Array) -> np.ndarray:
    """Which texts hold a character or pair that is not plain."""
    data, offsets = column_bytes(column)
    odd = _KIND[data] == _ODD
    for first, second in _ODD_PAIRS:
        odd[:-1] |= (data[:-1] == first) & (data[1:] == second)
    out = np.zeros(len(column), dtype=bool)
    out[np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1] = True
    return out


def plain_parts(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of plain texts, and the number of the first part of each text (and of one past all)."""
    data, offsets = column_bytes(pc.utf8_lower(column))
    kind = _KIND[data]
    inside = kind != _SPACE
    begins = kind == _DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins[offsets[offsets < len(data)]] = True
    begins &= inside
    first = np.searchsorted(np.flatnonzero(begins), offsets)
    letters = data[inside]
    edges = np.append(np.flatnonzero(begins[inside]), len(letters)).astype(np.int64)
    buffers = [None, pa.py_buffer(edges), pa.py_buffer(letters)]
    return pa.Array.from_buffers(pa.large_string(), len(edges) - 1, buffers), first


class PartTokenizer:
    """Packed ids (little-endian, ``dtype``) of texts, equal to encoding each text as a whole.

    ``plain`` reads the strings of special tokens in a text as ordinary text. Ids of parts take
    ``cache_bytes`` at most, beside those of the texts at hand: when the younger generation
    holds half of that, it becomes the older one, whose parts live on only if they are met again.
    From then on a part met for the first time only leaves a mark (one byte for ``MARK_SHARE`` of
    the cache, found by the part's hash; another part's mark lets one in too early, no more).
    """

    def __init__(
        self,
        path: str | None = None,
        dtype: str = "<u4",
        plain: bool = False,
        cache_bytes: int = CACHE_BYTES,
    ):
        from tokenizers import Tokenizer, pre_tokenizers

        # A task has one core; threads of each worker would only wait for each other's.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        path = path or default_path()
        self.whole = Tokenizer.from_file(path)
        if plain:
            self.whole.encode_special_tokens = True
        self.dtype, self.cache_bytes = np.dtype(dtype), cache_bytes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes of the younger generation
        self.marks = bytearray(max(1, cache_bytes // MARK_SHARE))
        self.marked = 0
        vocabulary = _by_parts(path)
        self.by_parts = vocabulary is not None
        if self.by_parts:
            self.model = Tokenizer(self.whole.model)
            self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(_SUFFIX)]] = True
            self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.shown = {}

    def _show(self, text: str) -> str:
        """The text as the model sees it: one visible sign per byte of each letter."""
        if text.isascii():
            return text
        for char in set(text) - self.shown.keys():
            self.shown[char] = self.as_bytes.pre_tokenize_str(char)[0][0]
        other = {ord(c): s for c, s in self.shown.items() if c != s and c != " "}
        return text.translate(other)

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of plain parts. The last token of each part carries the end-of-word suffix."""
        if not parts:
            return []
        joined = [self._show(" ".join(parts[at : at + 1000])) for at in range(0, len(parts), 1000)]
        encoded = self.model.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids) for e in encoded])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(parts):
            raise ValueError("the tokenizer does not keep parts apart")
        packed, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
        edges = [0, *(stops * width).tolist()]
        return [packed[a:b] for a, b in zip(edges, edges[1:])]

    def _split(self, text: str | None) -> list[str]:
        """Parts of a text; a word that is not plain is a part led by a space."""
        if not text:
            return []
        if not _NOT_PLAIN.search(text):
            return _PART.findall(text.lower())
        out = []
        for word in text.translate(_OTHER_SPACES).split(" "):
            if _NOT_PLAIN.search(word):
                out.append(" " + word)
            else:
                out += _PART.findall(word.lower())
        return out

    def pack(self, texts: pa.Array | Iterable[str | None]) -> list[bytes]:
        """Packed ids of each text; null is empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(list(texts), pa.large_string())
        if not self.by_parts:
            return self._whole([text or "" for text in texts.to_pylist()])
        odd = not_plain(texts)
        plain = iter(self._packed(*plain_parts(texts.filter(pa.array(~odd)))))
        split = [self._split(text) for text in texts.filter(pa.array(odd)).to_pylist()]
        first = np.cumsum([0, *map(len, split)])
        parts = pa.array(list(chain.from_iterable(split)), pa.large_string())
        mixed = iter(self._packed(parts, first))
        return [next(mixed if is_odd else plain) for is_odd in odd.tolist()]

    def _packed(self, parts: pa.Array, first: np.ndarray) -> list[bytes]:
        """Packed ids of texts that begin with the parts of the numbers ``first``."""
        if not len(parts):
            return [b""] * (len(first) - 1)
        coded = parts.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._ids(different), pa.large_binary())
        taken = ids.take(coded.indices)
        _, offsets, data = taken.buffers()
        edges = np.frombuffer(offsets, dtype=np.int64)[taken.offset + first].tolist()
        view = memoryview(data)
        return [view[a:b].tobytes() for a, b in zip(edges, edges[1:])]

    def _ids(self, parts: list[str]) -> list[bytes]:
        """Packed ids of different parts."""
        found = list(map(self.young.get, parts))
        places = [i for i, ids in enumerate(found) if ids is None]
        missing = [parts[i] for i in places]
        ids_of = {part: self.old[part] for part in missing if part in self.old}
        new = [part for part in missing if part not in ids_of]
        kept = list(ids_of) + self._admitted(new)
        odd = [part for part in new if part[0] == " "]
        plain = sorted((part for part in new if part[0] != " "), key=str.isascii)
        ids_of.update(zip(odd, self._whole([part[1:] for part in odd])))
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            ids_of.update(zip(some, self._parts(some)))
        for i, part in zip(places, missing):
            found[i] = ids_of[part]
        self._keep({part: ids_of[part] for part in kept})
        return found

    def _admitted(self, new: list[str]) -> list[str]:
        """Those of new parts that may enter the cache."""
        marks, size = self.marks, len(self.marks)
        places = [hash(part) % size for part in new]
        out = [part for part, at in zip(new, places) if marks[at]] if self.old else new
        self.marked += len(new) - len(out)
        for at in places:
            marks[at] = 1
        if 4 * self.marked > size:
            self.marks, self.marked = bytearray(size), 0
        return out

    def _keep(self, added: dict[str, bytes]) -> None:
        """Add parts to the younger generation, as far as half of the bound has room for them."""
        size = sum(map(len, added)) + sum(map(len, added.values())) + PART_BYTES * len(added)
        if self.held + size > self.cache_bytes // 2:
            self.old, self.young, self.held = self.young, {}, 0
        if size <= self.cache_bytes // 2:
            self.young.update(added)
            self.held += size


@functools.lru_cache(maxsize=1)
def shared(path: str | None = None, dtype: str = "<u4", plain: bool = False) -> PartTokenizer:
    """The tokenizer of this process.

    A worker process serves many tasks. One tokenizer for all of them is read once, keeps what it
    has cached, and holds the same memory throughout; a new one per task would leave about 35 MB
    behind each time, in the memory pools of the threads it runs on.
    """
    return PartTokenizer(path, dtype, plain)
