"""A compressed FM-index over many short sequences of integers, and matching statistics against it.

The index holds the Burrows-Wheeler transform of the sequences in a wavelet matrix of packed bits. All queries take a step together:
a step of the backward search is a handful of array operations, whatever the number of queries.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class Bits:
    """A packed bit array with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.word = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.word.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.word))[:-1]]).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        below = (_ONE << (i & 63).astype(np.uint64)) - _ONE
        return self.before[at] + np.bitwise_count(self.word[at] & below)


class Wavelet:
    """A wavelet matrix: how often a symbol occurs before a position."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.levels = max(1, int(kinds - 1).bit_length())
        self.bits, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = bit == 1
            self.bits.append(Bits(ones))
            self.zeros.append(int(len(symbols) - ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.base = self._descend(np.arange(kinds), np.zeros(kinds, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.bits[k].rank(i)
            i = np.where((symbol >> level) & 1 == 1, self.zeros[k] + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._descend(symbol, i) - self.base[symbol]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes up to their separator (0); equal ones in the order of their positions. ``depth`` is the length of the longest
    sequence with its separator."""
    n = len(text)
    room = np.flatnonzero(text == 0)
    room = np.repeat(room, np.diff(np.concatenate([[-1], room]))) - np.arange(n)  # symbols before the separator
    bits = np.uint64(max(1, int(text.max()).bit_length()))
    known = max(1, min(3, 63 // int(bits)))
    key = np.zeros(n, np.uint64)
    for j in range(known):
        piece = np.zeros(n, np.uint64)
        piece[: n - j] = text[j:]
        piece[room < j] = 0
        key = (key << bits) | piece
    while True:
        order = np.argsort(key, kind="stable")
        same = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(same[1:] != same[:-1])]).astype(np.uint64)
        if known >= depth:
            return order
        follow = np.zeros(n, np.uint64)
        follow[: n - known] = rank[known:]
        follow[room < known] = 0
        key = (rank << np.uint64(32)) | follow
        known *= 2


class FMIndex:
    """An index of sequences over symbols 1, 2, ..., each ended by a 0 in ``text``; matches are followed up to ``limit`` symbols.

    ``group_first[g]`` is the smallest text position of the sequences that share their first ``limit`` symbols in group g.
    """

    def __init__(self, text: np.ndarray, limit: int):
        self.limit, n = limit, len(text)
        ends = np.flatnonzero(text == 0)
        depth = int(np.diff(np.concatenate([[-1], ends])).max())
        # Matches are followed up to ``limit`` symbols and one more is read before them, so suffixes need no order beyond that: intervals
        # and ranks are only taken at the bounds of groups that share at most ``limit`` symbols, which stand whole in this order.
        order = suffix_array(text, min(depth, limit + 1))
        kinds = int(text.max()) + 1
        self.count = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=kinds))])
        last = text[order - 1]  # the text ends with a separator, which also stands before its first symbol
        self.wavelet = Wavelet(last.astype(np.int64), kinds)
        self.n, self.kinds = n, kinds
        self.lcp = self._lcp(text, order)
        opens = self.lcp < limit
        self.group = np.cumsum(opens) - 1
        self.low = np.flatnonzero(opens)
        self.high = np.append(self.low[1:], n)
        self.group_first = np.minimum.reduceat(order, self.low)

    def _lcp(self, text: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Length of what each suffix shares with the one before it, up to the limit and the separator."""
        out = np.zeros(self.n + 1, np.uint8 if self.limit < 256 else np.int32)
        a, b = order[1:], order[:-1]
        live = np.arange(1, self.n)
        for d in range(self.limit):
            x = text[a + d]
            same = (x == text[b + d]) & (x != 0)
            live, a, b = live[same], a[same], b[same]
            out[live] = d + 1
            inside = np.maximum(a, b) + d + 1 < self.n
            if not inside.all():
                live, a, b = live[inside], a[inside], b[inside]
        return out[: self.n]

    def _step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (self.count[symbol] + self.wavelet.rank(symbol, edge) for edge in (low, high))

    def _widen(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next wider interval: that of the longest shorter prefix that occurs more often."""
        lcp = np.append(self.lcp, 0).astype(np.int64)
        depth = np.maximum(lcp[low], lcp[high])
        low, high = low.copy(), high.copy()
        for edge, step in ((low, -1), (high, 1)):
            live = np.flatnonzero((lcp[edge] >= depth) & (edge > 0) & (edge < self.n))
            while len(live):
                edge[live] += step
                live = live[(edge[live] > 0) & (edge[live] < self.n)]
                live = live[lcp[edge[live]] >= depth[live]]
        none = depth == 0
        low[none], high[none] = 0, self.n
        return depth, low, high

    def matching(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the queries symbols[start[i] : start[i] + length[i]], at each of their positions: how many symbols from there
        on occur in the index (up to the limit), and the group of suffixes they occur in where the limit is reached, else -1.

        Queries are read from their ends. A match that can't be extended falls back to the next shorter prefix that occurs more often.
        A symbol of 0 or beyond the index's own matches nothing.
        """
        found, group = np.zeros(len(symbols), np.int32), np.full(len(symbols), -1, np.int64)
        live = np.argsort(-length, kind="stable")
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.n)
        size = np.zeros(len(live), np.int64)
        steps = int(length.max()) if len(length) else 0
        for t in range(1, steps + 1):
            live = live[: np.searchsorted(-length[live], -t, "right")]
            low, high, size = low[: len(live)], high[: len(live)], size[: len(live)]
            at = start[live] + length[live] - t
            symbol = symbols[at]
            alien = (symbol <= 0) | (symbol >= self.kinds)
            safe = np.where(alien, 0, symbol)
            a, b = self._step(safe, low, high)
            fails = np.flatnonzero((a >= b) & ~alien)
            while len(fails):
                atop = size[fails] == 0
                a[fails[atop]], b[fails[atop]] = 0, 0
                fails = fails[~atop]
                if not len(fails):
                    break
                size[fails], low[fails], high[fails] = self._widen(low[fails], high[fails])
                a[fails], b[fails] = self._step(safe[fails], low[fails], high[fails])
                fails = fails[a[fails] >= b[fails]]
            good = (a < b) & ~alien
            size = np.where(good, size + 1, 0)
            low, high = np.where(good, a, 0), np.where(good, b, self.n)
            full = np.flatnonzero(size >= self.limit)
            own = self.group[low[full]]
            low[full], high[full], size[full] = self.low[own], self.high[own], self.limit
            found[at] = size
            group[at[full]] = own
        return found, group
