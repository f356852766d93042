"""A compressed FM-index over numbers: a wavelet tree of its Burrows-Wheeler transform.

The tree is kept level by level (bits of the symbols from the highest on, each level stably
sorted by the bits above), so that a rank is one look at a bit vector per level.  All searches
are carried out for many patterns at once.
"""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


class Bits:
    """A bit vector with constant-time rank; select looks for the word by halving."""

    def __init__(self, bits: np.ndarray):
        pad = -len(bits) % 64 + 64
        packed = np.packbits(np.concatenate([bits, np.zeros(pad, bits.dtype)]), bitorder="little")
        self.words = packed.view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)
        self.n_zeros = len(bits) - int(counts.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        inside = (ONE << (at & 63).astype(np.uint64)) - ONE
        return self.before[word] + np.bitwise_count(self.words[word] & inside)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & ONE

    def select(self, number: np.ndarray) -> np.ndarray:
        """Where the ones of these numbers (from 0 on) stand."""
        word = np.searchsorted(self.before, number, side="right") - 1
        left, place = number - self.before[word], word << 6
        bits = self.words[word]
        for width in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(bits & ((ONE << np.uint64(width)) - ONE))
            beyond = left >= ones
            left = left - np.where(beyond, ones, 0)
            place = place + np.where(beyond, width, 0)
            bits = np.where(beyond, bits >> np.uint64(width), bits)
        return place


class WaveletTree:
    def __init__(self, symbols: np.ndarray, n_levels: int):
        self.levels = []
        self.n_levels = n_levels
        for level in range(n_levels):
            ones = (symbols >> (n_levels - 1 - level)) & 1 == 1
            self.levels.append(Bits(ones))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``, counted from where the symbol's run begins."""
        for level, bits in enumerate(self.levels):
            one = (symbol >> (self.n_levels - 1 - level)) & 1 == 1
            ones = bits.rank(at)
            at = np.where(one, bits.n_zeros + ones, at - ones)
        return at

    def get(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and the position's rank as ``rank`` counts it."""
        symbol = np.zeros(len(at), np.int64)
        for bits in self.levels:
            one = bits.get(at) == ONE
            ones = bits.rank(at)
            at = np.where(one, bits.n_zeros + ones, at - ones)
            symbol = symbol * 2 + one
        return symbol, at


def suffix_order(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Positions by their suffixes.  Prefix doubling; only tied suffixes are sorted again."""
    n = len(symbols)
    width = max(1, int(n_symbols).bit_length())
    span = max(1, 62 // width)
    key = np.zeros(n, np.int64)
    for i in range(span):
        key <<= width
        if i < n:
            key[: n - i] += symbols[i:] + 1
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    del key, sorted_key
    tied = _tied_slots(new)
    while len(tied):
        at = order[tied]
        follow = np.where(at + span < n, rank[np.minimum(at + span, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + follow
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[tied] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        # slots alone in their group are settled
        tied = tied[~(new & np.concatenate([new[1:], [True]]))]
        span *= 2
    return order


def _tied_slots(new: np.ndarray) -> np.ndarray:
    alone = new & np.concatenate([new[1:], [True]])
    return np.flatnonzero(~alone)


class FMIndex:
    """Index of a text of numbers below ``n_symbols`` that begins with its only 0.

    ``sample`` keeps every so-many-th text position for locating.
    """

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = 16):
        text = np.asarray(text, np.int64)
        self.n = len(text)
        self.order = suffix_order(text, n_symbols)
        self.levels = max(1, int(n_symbols - 1).bit_length())
        last = text[self.order - 1]  # the symbol before each suffix; the text counts as a ring
        self.tree = WaveletTree(last, self.levels)
        # where a symbol's run begins in the last level, and its first suffix
        counts = np.bincount(text, minlength=1 << self.levels)
        self.first = np.cumsum(counts) - counts
        self.runs = self.tree.rank(np.arange(1 << self.levels), np.zeros(1 << self.levels, np.int64))
        kept = self.order % sample == 0
        self.marked = Bits(kept)
        self.samples = self.order[kept].astype(np.int32)

    def drop_order(self) -> None:
        """Keep the compressed parts alone."""
        self.order = None

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: from the rows of X to those of ``symbol`` X."""
        base = self.first[symbol] - self.runs[symbol]
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return base + both[: len(low)], base + both[len(low):]

    def next_rows(self) -> np.ndarray:
        """For each row, that of the suffix one symbol shorter: the tree's steps backward, turned around."""
        symbol, at = self.tree.get(np.arange(self.n))
        follow = np.empty(self.n, np.int32)
        follow[self.first[symbol] - self.runs[symbol] + at] = np.arange(self.n, dtype=np.int32)
        return follow

    def parents(self, depth: int) -> Bits:
        """Marks rows that share fewer than ``depth`` symbols with the row before, and the end.

        Found from the tree alone, by doubling: rows share a + b symbols if they share a, and the rows a
        symbols on share b.
        """
        begins = np.zeros(self.n, bool)
        begins[self.first[self.first < self.n]] = True  # rows that begin with another symbol than the row before
        power, jump = begins, self.next_rows()  # of the doubled length
        marks, on = np.zeros(self.n, bool), None  # of the length so far
        marks[:1] = True
        while depth:
            if depth & 1:
                marks = power if on is None else self._longer(marks, on, power)
                on = jump if on is None else jump[on]
            depth >>= 1
            if depth:
                power, jump = self._longer(power, jump, power), jump[jump]
        return Bits(np.append(marks, True))

    @staticmethod
    def _longer(marks: np.ndarray, on: np.ndarray, more: np.ndarray) -> np.ndarray:
        tied = np.flatnonzero(~marks)
        group = np.cumsum(more, dtype=np.int32)
        out = marks.copy()
        out[tied] = group[on[tied]] != group[on[tied - 1]]
        return out

    @staticmethod
    def widen(parents: Bits, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From rows to all that share the depth of ``parents`` with them."""
        return parents.select(parents.rank(low + 1) - 1), parents.select(parents.rank(high))

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each pattern; ``patterns`` holds them flush right, one a line."""
        m, width = patterns.shape
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        for step in range(1, width + 1):
            live = np.flatnonzero((lengths >= step) & (low < high))
            if not len(live):
                break
            low[live], high[live] = self.step(patterns[live, width - step], low[live], high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back to the next kept position."""
        rows = np.array(rows, np.int64)
        found = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            hit = self.marked.get(rows) == ONE
            found[left[hit]] = self.samples[self.marked.rank(rows[hit])] + steps
            left, rows = left[~hit], rows[~hit]
            if not len(left):
                break
            symbol, at = self.tree.get(rows)
            rows = self.first[symbol] - self.runs[symbol] + at
            steps += 1
        return found
