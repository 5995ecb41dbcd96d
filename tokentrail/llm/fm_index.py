"""A compressed FM-index over integer sequences: Burrows-Wheeler transform in a wavelet matrix of packed bits.

The text itself is not kept. Beside the transform there are two bit vectors, which mark where suffixes begin to differ
within the threshold and within one symbol less, the places of a sample of suffixes, and the earliest place of each
group of suffixes that are alike up to the threshold. `size_in_bytes` tells what all that takes.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words with a count before each word; rank and select of many places at once."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)[:-1]]).astype(np.int32)
        self.zeros = len(bits) - int(bits.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def select1(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th set bit, from 0; k must be less than their number."""
        word = np.searchsorted(self.before, k, side="right") - 1
        left, rest, at = self.words[word], k - self.before[word], np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(left & np.uint64((1 << half) - 1)).astype(np.int64)
            skip = rest >= low
            rest, at = np.where(skip, rest - low, rest), np.where(skip, at + half, at)
            left = np.where(skip, left >> np.uint64(half), left)
        return (word << 6) + at

    @property
    def size_in_bytes(self) -> int:
        return self.words.nbytes + self.before.nbytes


class WaveletMatrix:
    def __init__(self, data: np.ndarray, sigma: int) -> None:
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits = []
        for level in range(self.levels - 1, -1, -1):
            ones = (data >> level & 1).astype(bool)
            self.bits.append(Bits(ones))
            data = np.concatenate([data[~ones], data[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[k] in data[:i[k]]."""
        start = np.zeros_like(i)
        for depth, bits in enumerate(self.bits):
            one = (symbol >> (self.levels - 1 - depth) & 1).astype(bool)
            both = bits.rank1(np.concatenate([start, i]))
            a, b = both[: len(i)], both[len(i) :]
            start, i = np.where(one, bits.zeros + a, start - a), np.where(one, bits.zeros + b, i - b)
        return i - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(data[i], occurrences of that symbol before i)."""
        start, symbol = np.zeros_like(i), np.zeros_like(i)
        for bits in self.bits:
            one = bits.get(i)
            both = bits.rank1(np.concatenate([start, i]))
            a, b = both[: len(i)], both[len(i) :]
            start, i = np.where(one, bits.zeros + a, start - a), np.where(one, bits.zeros + b, i - b)
            symbol = symbol << 1 | one
        return symbol, i - start


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and how many symbols, up to depth, each shares with the one before it."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    packed = max(1, 62 // bits)
    padded = np.concatenate([text, np.zeros(packed, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(packed):
        key = key << bits | padded[i : i + n]
    order, h = np.argsort(key), packed
    while True:
        # prefix doubling: the order by h symbols gives that by 2 h
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or h >= n:
            break
        key = rank * (n + 1)
        key[: max(0, n - h)] += rank[h:] + 1
        order, h = np.argsort(key), 2 * h
    shared = np.zeros(n, np.int64)
    a, b = order[1:], order[:-1]
    alive = np.arange(n - 1)
    for d in range(depth):
        alive = alive[np.maximum(a[alive], b[alive]) + d < n]
        alive = alive[text[a[alive] + d] == text[b[alive] + d]]
        shared[alive + 1] = d + 1
    return order, shared


class FMIndex:
    """Index of sequences of symbols from 1; 0 is put behind each of them and never matches. Places are those of the
    sequences laid end to end, each with its 0."""

    def __init__(self, sequences: list[np.ndarray], threshold: int, every: int = 16) -> None:
        self.threshold = threshold
        sizes = np.array([len(s) + 1 for s in sequences] or [1], np.int64)
        self.starts = (np.cumsum(sizes) - sizes).astype(np.int32)
        gap = np.zeros(1, np.int64)
        text = np.concatenate([x for s in sequences for x in (s, gap)]) if sequences else gap
        order, shared = suffix_array(text, threshold)
        self.n, self.sigma = len(text), int(text.max()) + 1
        counts = np.bincount(text, minlength=self.sigma)
        self.first = (np.cumsum(counts) - counts).astype(np.int32)
        self.bwt = WaveletMatrix(text[order - 1], self.sigma)
        # groups of suffixes that are alike in threshold symbols, and in one less
        self.opens = {k: Bits(np.append(shared < k, True) if k else np.eye(1, self.n + 1, dtype=bool)[0] | np.eye(1, self.n + 1, self.n, dtype=bool)[0]) for k in {threshold - 1, threshold}}
        heads = np.flatnonzero(shared < threshold)
        several = np.diff(np.append(heads, self.n)) > 1
        self.several = Bits(several)
        self.earliest = np.minimum.reduceat(order, heads)[several].astype(np.int32)
        # every so many places of each sequence are kept, its first one included
        offset = np.arange(self.n) - np.repeat(self.starts, sizes)
        kept = (offset % every == 0)[order]
        self.kept, self.place = Bits(kept), order[kept].astype(np.int32)

    @property
    def size_in_bytes(self) -> int:
        parts = [*self.bwt.bits, *self.opens.values(), self.several, self.kept]
        return sum(x.size_in_bytes for x in parts) + sum(x.nbytes for x in (self.starts, self.first, self.earliest, self.place))

    def _backward(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = symbol < self.sigma
        s = np.where(known, symbol, 0)
        both = self.bwt.rank(np.concatenate([s, s]), np.concatenate([low, high]))
        low2, high2 = self.first[s] + both[: len(s)], self.first[s] + both[len(s) :]
        return low2, np.where(known & (symbol > 0), high2, low2)

    def _group(self, row: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, first row, row behind the last) of the group of suffixes like a row's in so many symbols."""
        opens = self.opens[symbols]
        number = opens.rank1(row + 1) - 1
        ends = opens.select1(np.concatenate([number, number + 1]))
        return number, ends[: len(row)], ends[len(row) :]

    def count(self, pattern: np.ndarray) -> int:
        low, high = np.array([0]), np.array([self.n])
        for c in pattern[::-1]:
            low, high = self._backward(np.array([c]), low, high)
        return int(high[0] - low[0])

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of suffixes, by steps back to the nearest kept one. Rows of the 0 symbol have none: -1."""
        rows = np.asarray(rows, np.int64)
        out, steps, at, live = np.full(len(rows), -1, np.int64), 0, rows.copy(), np.flatnonzero(rows >= self.first[1] if self.sigma > 1 else rows < 0)
        while len(live):
            here = self.kept.get(at[live])
            done = live[here]
            out[done] = self.place[self.kept.rank1(at[done])] + steps
            live = live[~here]
            symbol, before = self.bwt.access(at[live])
            at[live] = self.first[symbol] + before
            steps += 1
        return out

    def first_places(self, rows: np.ndarray) -> np.ndarray:
        """The earliest place of each row's group of full matches; -1 for a group of one, whose place is its own."""
        number, _, _ = self._group(rows, self.threshold)
        out = np.full(len(rows), -1, np.int64)
        many = self.several.get(number)
        out[many] = self.earliest[self.several.rank1(number[many])]
        return out

    def matching_statistics(self, queries: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each place of each query: how many symbols from there occur in the index, up to the threshold, and
        where the match is of full length a row of its interval (-1 otherwise).

        All queries go backwards side by side. A full match gives up its last symbol before the next step: its
        interval widens to the group that shares one symbol less. A shorter match that cannot be extended is
        shortened likewise, by a new search.
        """
        t = self.threshold
        sizes = np.array([len(q) for q in queries], np.int64)
        if not len(sizes):
            return [], []
        width = int(sizes.max(initial=0))
        grid = np.zeros((len(queries), width), np.int64)
        for k, q in enumerate(queries):
            grid[k, width - len(q) :] = q
        low, high, length = np.zeros(len(queries), np.int64), np.full(len(queries), self.n, np.int64), np.zeros(len(queries), np.int64)
        all_len, all_row = np.zeros((len(queries), width), np.int64), np.full((len(queries), width), -1, np.int64)
        for j in range(width - 1, -1, -1):
            live = np.flatnonzero(sizes >= width - j)
            full = live[length[live] == t]
            if len(full):
                _, low[full], high[full] = self._group(low[full], t - 1)
                length[full] = t - 1
            a, b = self._backward(grid[live, j], low[live], high[live])
            hit = b > a
            ok = live[hit]
            low[ok], high[ok], length[ok] = a[hit], b[hit], length[ok] + 1
            for k in live[~hit]:
                # the longest shorter match that starts here: search it anew, from its end
                n = int(length[k])
                while True:
                    x, y, part = np.array([0]), np.array([self.n]), grid[k, j : j + n]
                    for c in part[::-1]:
                        x, y = self._backward(np.array([c]), x, y)
                        if y[0] <= x[0]:
                            break
                    if not n or y[0] > x[0]:
                        break
                    n -= 1
                low[k], high[k], length[k] = x[0], y[0], n
            all_len[live, j] = length[live]
            done = live[length[live] == t]
            all_row[done, j] = low[done]
        return [all_len[k, width - n :] for k, n in enumerate(sizes)], [all_row[k, width - n :] for k, n in enumerate(sizes)]
