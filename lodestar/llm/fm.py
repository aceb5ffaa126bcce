"""FM-index over segments of numbered words: backward search on a wavelet matrix.

The text is a row of segments of symbols 1, 2, ... with a 0 after each; the zeros
count as distinct, smaller than every word and rising with their place, so suffixes
are told apart within their own segment.  Only bit-packed levels of the
Burrows-Wheeler transform with one count per 64 bits are kept for searching.
"""

from __future__ import annotations

import numpy as np

_BELOW = np.array([(1 << i) - 1 for i in range(64)], dtype=np.uint64)


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, a number for each place that is equal where the ``depth`` symbols
    from there are equal), by prefix doubling; zeros are distinct."""
    n = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum()) - 1).astype(np.int64)
    bits = max(1, int(n + 1).bit_length())
    known, deep, order = 1, None, None
    low = (1 << bits) - 1
    while True:
        if 2 * known > depth and deep is None:
            # ranks are equal for `known` <= depth symbols: two overlapping ones give depth
            ahead = np.zeros(n, np.int64)
            ahead[:n - (depth - known)] = rank[depth - known:]
            deep = rank * (n + 1) + ahead if depth > known else rank.copy()
        ahead = np.zeros(n, np.int64)
        ahead[:n - known if known < n else 0] = rank[known:] + 1
        if 3 * bits <= 63:
            packed = np.sort((((rank << bits) | ahead) << bits) | np.arange(n))
            order, key = packed & low, packed >> bits
        else:
            both = rank * (n + 2) + ahead
            order = np.argsort(both, kind="stable")
            key = both[order]
        new = np.zeros(n, np.int64)
        new[1:] = np.cumsum(key[1:] != key[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = new
        known *= 2
        if n == 0 or new[-1] == n - 1:
            break
    if deep is None:
        deep = rank
    return order, deep


class WaveletMatrix:
    """Rank of symbols in a sequence, a packed bit level at a time."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        top = int(symbols.max()) if self.n else 0
        self.depth = max(1, top.bit_length())
        self.levels = []
        for level in range(self.depth - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            padded = np.zeros((self.n // 64 + 1) * 64, dtype=bool)
            padded[:self.n] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1]
            zeros = self.n - int(bit.sum())
            self.levels.append((words, before, zeros))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        every = np.arange(top + 1)
        self.base = self.place(every, np.zeros(top + 1, np.int64))

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first ``i`` entries' copies of ``symbol`` end in the last level's order."""
        for level, (words, before, zeros) in enumerate(self.levels):
            at = i >> 6
            ones = before[at] + np.bitwise_count(words[at] & _BELOW[i & 63])
            up = (symbol >> (self.depth - 1 - level)) & 1 == 1
            i = np.where(up, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs among the first ``i`` entries."""
        return self.place(symbol, i) - self.base[symbol]


class FMIndex:
    def __init__(self, text: np.ndarray, depth: int):
        """``depth``: the match length to which intervals can be cut back."""
        order, deep = suffix_order(text, depth)
        n = len(text)
        last = text[order - 1] if n else text          # the symbol before each suffix
        self.wavelet = WaveletMatrix(last.astype(np.int64))
        counts = np.bincount(text, minlength=int(text.max()) + 1 if n else 1)
        self.smaller = np.cumsum(counts) - counts
        # intervals of suffixes that share `depth` symbols, and their earliest place
        edge = np.flatnonzero(np.concatenate([[True], deep[order[1:]] != deep[order[:-1]]])) if n else np.zeros(0, np.int64)
        self.group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, n)))
        self.first, self.after = edge, np.append(edge[1:], n)
        self.earliest = np.minimum.reduceat(order, edge) if n else order

    def step(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the intervals of ``symbol`` followed by what [lo, hi) matches."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.smaller[symbol]
        return base + both[:len(lo)], base + both[len(lo):]

    def earlier(self, text: np.ndarray, start: np.ndarray, size: np.ndarray, depth: int) -> list[np.ndarray]:
        """For each stretch ``text[start:start+size]`` of the indexed text, which of its
        windows of ``depth`` symbols occur earlier.  Stretches are streamed backwards
        together; each step extends the match by one symbol, and a match longer than
        ``depth`` is cut back to ``depth``, so its interval is that of the window."""
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        lo = np.zeros(len(start), np.int64)
        hi = np.full(len(start), len(text), np.int64)
        first = np.concatenate([[0], np.cumsum(np.maximum(size - depth + 1, 0))])
        found = np.zeros(first[-1], dtype=bool)
        for t in range(1, int(size[0]) + 1 if len(size) else 0):
            live = int(np.searchsorted(-size, -t, side="right"))
            at = start[:live] + size[:live] - t
            lo, hi = self.step(lo[:live], hi[:live], text[at])
            if t >= depth:
                group = self.group[lo]
                found[first[:live] + size[:live] - t] = (hi > lo) & (self.earliest[group] < at)
                lo, hi = self.first[group], self.after[group]
        out = [None] * len(start)
        for i, k in enumerate(order):
            out[k] = found[first[i]:first[i + 1]]
        return out
