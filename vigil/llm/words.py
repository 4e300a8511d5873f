"""Words of many texts at once: positions and 64-bit hashes from the UTF-8 bytes of an Arrow column.

All functions work on whole texts. Long texts are cut into pieces at separators, so that the
working memory does not grow with the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

# Bytes that end a word: white space x20 and x09-x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

# Bytes that end a word when only letters, digits and bytes from x80 belong to words.
PUNCTUATION = np.zeros(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    PUNCTUATION[_low : _high + 1] = True

# A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the odd hash base modulo 2^64."""
    global _powers
    while len(_powers) < n:
        step = np.uint64(pow(_BASE, len(_powers), 1 << 64))
        _powers = np.concatenate([_powers, _powers * step])
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Word hashes are polynomials modulo the prime 2^61 - 1: modulo a power of two, words of Thue and
# Morse collide whatever the base is.
_PRIME = (1 << 61) - 1
_prime_powers = np.ones((2, 0), dtype=np.uint64)


def prime_powers(n: int) -> np.ndarray:
    """The first n powers of the base modulo the prime: their low 32 bits and the rest."""
    global _prime_powers
    have = _prime_powers.shape[1]
    if have < n:
        more = np.empty((2, max(n, 2 * have, 64)), dtype=np.uint64)
        more[:, :have] = _prime_powers
        base = _BASE % _PRIME
        power = pow(base, have, _PRIME)
        for i in range(have, more.shape[1]):
            more[0, i], more[1, i] = power & 0xFFFFFFFF, power >> 32
            power = power * base % _PRIME
        _prime_powers = more
    return _prime_powers[:, :n]


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    return mix(mix(a + np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xD6E8FEB86659FD93)))


@dataclass
class Words:
    """Words of the texts of one column.

    ``first[i]:first[i + 1]`` are the words of text i; ``start`` and ``end`` are byte positions
    in ``data``, the joined bytes (lower-cased if asked for) of all texts.
    """

    data: np.ndarray
    text: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def words(self, i: int, low: int, high: int) -> list[bytes]:
        """Words low to high (exclusive) of text i."""
        a = self.first[i]
        b = min(a + high, self.first[i + 1])
        return [
            self.data[s:e].tobytes()
            for s, e in zip(self.start[a + low : b], self.end[a + low : b])
        ]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The joined UTF-8 bytes of a string column and the byte offset of each text. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _pieces(offsets: np.ndarray, data: np.ndarray, ends_word: np.ndarray):
    """Byte ranges of about PIECE_BYTES that end at a text's end or at a separator."""
    low, size = 0, int(offsets[-1])
    while low < size:
        high = min(size, low + PIECE_BYTES)
        if high < size:
            text_end = int(offsets[np.searchsorted(offsets, high, side="right") - 1])
            if text_end > low:
                high = text_end
            else:
                stop = int(offsets[np.searchsorted(offsets, high, side="left")])
                while high < stop and not ends_word[data[high]]:
                    high += 1
        yield low, high
        low = high


def split(
    column: pa.Array, separators: np.ndarray = SPACES, lower: bool = False, hashed: bool = True
) -> Words:
    """Words of every text of a string column, with one 64-bit hash per word.

    Equal words have equal hashes. Null and empty texts have no words.
    """
    data, offsets = column_bytes(column)
    if lower:
        data = LOWER[data]
    is_edge = np.zeros(len(data) + 1, dtype=bool)
    is_edge[offsets] = True
    starts, ends, hashes = [], [], []
    for low, high in _pieces(offsets, data, separators):
        part = data[low:high]
        inside = ~separators[part]
        edge = is_edge[low : high + 1].copy()
        edge[0] = edge[-1] = True
        begins = inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]]))
        stops = inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))
        s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        starts.append(s + low)
        ends.append(e + low)
        if hashed and len(s):
            size = e - s
            at = np.flatnonzero(inside)
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            place = np.arange(len(at)) - np.repeat(first, size)
            value = part[at].astype(np.uint64) + np.uint64(1)
            low_sum, high_sum = (
                np.add.reduceat(value * power[place], first)
                for power in prime_powers(int(size.max()))
            )
            hashes.append(combine(combine(high_sum, low_sum), size.astype(np.uint64)))
    start = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
    hash_ = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    first = np.searchsorted(start, offsets, side="left")
    return Words(data, offsets, first, start, end, hash_)


def feature_hash(words: Words) -> np.ndarray:
    """A quick hash of every word, for features only: different words may well share it."""
    size = words.end - words.start
    if not len(size):
        return np.zeros(0, dtype=np.uint64)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    value = words.data[np.repeat(words.start, size) + place].astype(np.uint64) + np.uint64(1)
    total = np.add.reduceat(value * powers(int(size.max()))[place], first)
    return mix(total + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of n consecutive words (starting at each word), and whether the run
    stays inside its text."""
    h = words.hash
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(len(h), dtype=np.uint64), np.zeros(len(h), dtype=bool)
    # Runs of 1, 2, 4, ... words; at last two of them that overlap make up n.
    size = 1
    while 2 * size <= n:
        h = combine(h[: len(h) - size], h[size:])
        size *= 2
    if size < n:
        h = combine(h[:m], h[n - size : n - size + m])
    out = np.zeros(len(words.hash), dtype=np.uint64)
    out[:m] = mix(h[:m] + np.uint64(n))
    counts = np.diff(words.first)
    left = np.repeat(words.first[1:], counts) - np.arange(len(out))
    return out, left >= n


def joined(words: Words, i: int, keep: np.ndarray | None = None) -> bytes:
    """The words of text i (those marked in ``keep``) joined by one space."""
    a, b = words.first[i], words.first[i + 1]
    start, end = words.start[a:b], words.end[a:b]
    if keep is not None:
        start, end = start[keep], end[keep]
    if len(start) == 0:
        return b""
    size = end - start + 1
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    at = np.arange(int(size.sum())) - np.repeat(first - start, size)
    out = words.data[np.minimum(at, len(words.data) - 1)]
    out[(first + size - 1)] = 0x20
    return out[:-1].tobytes()
