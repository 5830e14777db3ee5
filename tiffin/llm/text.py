"""Words and shingles of whole Arrow batches as arrays of 64-bit hashes.

A word is a run of bytes other than space and 0x09-0x0D. All words of a batch are hashed together, a byte position at a time,
so the cost follows the number of bytes and no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
#: For comparing prose: every ASCII character other than a letter or a digit separates words.
PLAIN = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def chunks(column: pa.Array, limit: int) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column of at most ``limit`` bytes each, or of one row; with the number of the first row."""
    column = column.fill_null("") if column.null_count else column
    ends = _offsets(column)[1:]
    start = 0
    while start < len(column):
        base = int(_offsets(column)[start])
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, column.slice(start, stop - start)
        start = stop


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]


class Words:
    """The words of a slice of texts: byte ranges, hashes, and where each text's words begin.

    ``first[i] : first[i + 1]`` are the words of text i; ``data[start[j] : end[j]]`` are the bytes of word j. ``blank`` marks the bytes
    that separate words; ``lower`` lower-cases A-Z.
    """

    def __init__(self, column: pa.Array, lower: bool = False, blank: np.ndarray = _BLANK):
        offsets = _offsets(column).astype(np.int64)
        if len(column) and column.buffers()[2] is not None:
            data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        else:
            data = np.zeros(0, np.uint8)
        offsets -= offsets[0] if len(offsets) else 0
        self.data, self.offsets = _LOWER[data] if lower else data, offsets
        solid = ~blank[data]
        opens = solid.copy()
        opens[1:] &= ~solid[:-1]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        opens[heads] = solid[heads]
        closes = solid.copy()
        closes[:-1] &= ~solid[1:]
        tails = heads[heads > 0] - 1
        closes[tails] = solid[tails]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        length = self.end - self.start
        h = length.astype(np.uint64)
        at, longer, j = self.start, np.flatnonzero(length > 0), 0
        while len(longer):
            h[longer] = (h[longer] ^ self.data[at[longer] + j]) * _STEP
            h[longer] ^= h[longer] >> np.uint64(29)
            j += 1
            longer = longer[length[longer] > j]
        return mix(h)

    def text(self, i: int) -> np.ndarray:
        """Hashes of the words of text i."""
        return self.hash[self.first[i] : self.first[i + 1]]


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that begin at each word; the last n - 1 entries wrap around and mean nothing."""
    h = np.full(len(words), n, np.uint64)
    for j in range(n):
        h = (h ^ np.roll(words, -j)) * _STEP
        h ^= h >> np.uint64(31)
    return mix(h)


def ranges(start: np.ndarray, length: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """The numbers start[i] .. start[i] + length[i] - 1 of all i, one after the other."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, kind)
    keep = length > 0
    start, length = start[keep].astype(np.int64), length[keep].astype(np.int64)
    step = np.ones(total, kind)
    step[0] = start[0]
    step[np.cumsum(length)[:-1]] = start[1:] - (start[:-1] + length[:-1] - 1)
    return np.cumsum(step, dtype=kind, out=step)
