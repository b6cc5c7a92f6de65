"""Tokens, lines and n-grams of many texts at once, as 64-bit hashes in numpy arrays.

Texts are joined by newlines into one byte buffer, which no token crosses. The hash of a span is
a polynomial over random 64-bit byte values, read off a prefix sum, so no Python object is made
for a token.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Arrays of a chunk take some hundred bytes a byte of text, in every Python worker.
CHUNK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_NGRAM = np.uint64(0xD6E8FEB86659FD93)


def _byte_class(members: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


WHITE = _byte_class([0x20, *range(0x09, 0x0E)])
NOT_WHITE = ~WHITE
# Digits, lower-case letters and every byte of a character beyond ASCII.
ALNUM = _byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
CHAR_START = _byte_class(b for b in range(256) if b & 0xC0 != 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE + np.uint64(seed))


_VALUES = {seed: _byte_values(seed * 1_000_003 + 17) for seed in (0, 1)}
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + CHUNK_BYTES // 4)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class Texts:
    """A chunk of texts as one lower-cased (A-Z) byte buffer."""

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = b"\n".join(texts)
        self.raw = joined
        self.bytes = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        self.end = self.begin + sizes
        self._sums: dict[int, np.ndarray] = {}

    def runs(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every run of bytes of a class."""
        inside = np.zeros(len(self.bytes) + 2, dtype=np.int8)
        inside[1:-1] = members[self.bytes]
        step = np.diff(inside)
        return np.flatnonzero(step == 1), np.flatnonzero(step == -1)

    def hashes(self, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        powers, inverse = _power_tables(len(self.bytes) + 1)
        if seed not in self._sums:
            sums = np.zeros(len(self.bytes) + 1, dtype=np.uint64)
            np.cumsum(_VALUES[seed][self.bytes] * powers[: len(self.bytes)], out=sums[1:])
            self._sums[seed] = sums
        sums = self._sums[seed]
        value = (sums[end] - sums[begin]) * inverse[begin]
        return mix(value + (end - begin).astype(np.uint64) * _NGRAM)

    def counts(self, begin: np.ndarray) -> np.ndarray:
        """Spans per text, of spans given by their begin in ascending order."""
        edges = np.append(self.begin, len(self.bytes) + 1)
        return np.diff(np.searchsorted(begin, edges))

    def words(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every token, and tokens per text."""
        begin, end = self.runs(members)
        return self.hashes(begin, end), self.counts(begin)


def owners(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def ngrams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every n-gram; a text of fewer words, but not none, is one n-gram."""
    value = np.zeros(len(words), dtype=np.uint64)
    text = owners(counts)
    for i in range(n):
        left = max(0, len(words) - i)
        here = np.zeros(len(words), dtype=np.uint64)
        here[:left] = words[i:]
        inside = np.zeros(len(words), dtype=bool)
        inside[:left] = text[i:] == text[:left]
        # Past the end of a text the value stands still.
        value = np.where(inside, value * _NGRAM + here + np.uint64(i + 1), value)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    place = np.arange(len(words)) - first
    whole = (place + n <= counts[text]) | (place == 0)
    return mix(value[whole]), text[whole]


def distinct(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs in the order of texts, then values."""
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], text[new]


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about CHUNK_BYTES each."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= CHUNK_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
