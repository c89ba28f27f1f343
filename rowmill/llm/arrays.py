"""Texts as numpy arrays inside tasks: words, word hashes, n-gram hashes, winnowed positions.

Spark partitions and shuffles; these helpers only turn one piece of an Arrow batch into
arrays. A piece holds about a megabyte of text (one text at least), so a task's memory is
bounded by a few times its longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_U = np.uint64


def _alphabet(outside: Iterable[int]) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(outside)] = False
    return table


#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed, return.
BLANK_SEPARATED = _alphabet([0x20, *range(0x09, 0x0E)])
#: Words are runs of digits, a-z and all non-ASCII bytes, once A-Z is lower-cased.
LETTERS_AND_DIGITS = _alphabet([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as needed."""

    def __init__(self, base: int):
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_IN_WORD = _Powers(0xD6E8FEB86659FD93)
_IN_GRAM = (_Powers(0xA0761D6478BD642F), _Powers(0xE7037ED1A0B428DB))


def _spans(values: np.ndarray, powers: _Powers, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for many spans at once, by running sums."""
    up, down = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[end] - sums[start]) * down[start]


class Words:
    """The words of a few texts: byte range and hash of each word, word range of each text."""

    def __init__(self, texts: list[bytes | None], alphabet: np.ndarray = BLANK_SEPARATED, lower: bool = False):
        parts = [t or b"" for t in texts]
        self.raw = b"\n".join([*parts, b""])
        if lower:
            self.raw = self.raw.lower()
        data = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = alphabet[data]
        edges = np.flatnonzero(np.diff(inside))
        self.start, self.end = edges[::2], edges[1::2]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        #: words first[d] to first[d + 1] belong to text d
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self._data = data

    def hashes(self) -> np.ndarray:
        return mix(_spans(_BYTE_VALUES[self._data], _IN_WORD, self.start, self.end))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def room(self) -> np.ndarray:
        """For each word, how many words its text has from it to the end."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self.start))

    def words(self, a: int, b: int) -> list[bytes]:
        return [self.raw[s:e] for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]


def grams(word_hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each position on, one for each start."""
    return grams_between(word_hashes, np.arange(max(0, len(word_hashes) - length + 1)), length, seed)


def grams_between(word_hashes: np.ndarray, start: np.ndarray, length: int | np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of ``length`` words from each of the given starts. Seeds 0 and 1 are independent."""
    salt = np.asarray(length, np.uint64) * _U(0x9E3779B97F4A7C15)
    return mix(_spans(mix(word_hashes + _U(seed)), _IN_GRAM[seed], start, start + length) + salt)


def window_choice(gram_hashes: np.ndarray, width: int) -> np.ndarray:
    """Winnowing: for each run of ``width`` neighbouring grams, where its least one is.

    Of equal ones the rightmost counts, so the choice depends on the run's content alone.
    """
    n = len(gram_hashes)
    if n < width:
        return np.zeros(0, np.int64)
    place = np.arange(n, dtype=np.uint64)
    least = (gram_hashes & _U(0xFFFFFFFF00000000)) | (_U(0xFFFFFFFF) - place)
    reach = 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: n - width + 1], least[width - reach :])
    return (_U(0xFFFFFFFF) - (least & _U(0xFFFFFFFF))).astype(np.int64)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
