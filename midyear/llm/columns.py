"""The Burrows-Wheeler transform of a collection, built column by column from the right.

Every round inserts one symbol per document: the suffix that begins there takes its row among all
suffixes inserted so far.  The transform is kept by symbol: for each symbol, in order, the rows at
which it stands.  That list is in the order of the suffixes themselves, so the place at which a new
suffix enters is found by its symbol and the row of the suffix after it, and its entry there is where
the walk along a document goes on.  The common prefix of a new suffix with each of its neighbours is
one more than the least common prefix between the rows after them.  Both arrays are files that a round
reads from front to back and writes anew; they stay in memory while they are small.

Symbols are ``width`` consecutive bytes.  So that suffixes at every byte are compared, a text is
``width`` documents, cut short by 0 to ``width - 1`` bytes.
"""

from __future__ import annotations

import tempfile

import numpy as np

from midyear.llm.texts import KEEP

#: Bytes of a file kept in memory, and entries read at once.
SPOOL_BYTES, READ = 64_000_000, 1 << 18
ROW = np.uint64(0xFFFFFFFF)
SHIFT = np.uint64(32)


class Written:
    """An array in a file of the task's own, written and read from front to back."""

    def __init__(self, kind, spool: int):
        self.kind, self.n = np.dtype(kind), 0
        self.file = tempfile.SpooledTemporaryFile(max_size=spool)

    def add(self, values: np.ndarray) -> None:
        self.file.write(np.ascontiguousarray(values, self.kind).data)
        self.n += len(values)

    def blocks(self, most: int = READ):
        self.file.seek(0)
        while raw := self.file.read(most * self.kind.itemsize):
            yield np.frombuffer(raw, self.kind)

    def whole(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, self.kind), *self.blocks()])


def range_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first : last + 1]`` for each pair: two stretches of a power of two cover it."""
    out = np.empty(len(first), values.dtype)
    power = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    order = np.argsort(power.astype(np.uint8), kind="stable")
    cuts = np.searchsorted(power[order], np.arange(int(power.max(initial=0)) + 2))
    for p, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        some = order[low:high]  # ``values`` has the least of 2 ** p here
        out[some] = np.minimum(values[first[some]], values[last[some] + 1 - (1 << p)])
        if p + 2 < len(cuts):
            values = np.minimum(values[: -(1 << p)], values[1 << p :])
    return out


def repeated_starts(texts: list[bytes], window: int, width: int = 8, spool: int = SPOOL_BYTES) -> np.ndarray:
    """Which bytes of the joined texts begin a window that stands elsewhere in the collection too.

    ``width`` divides ``window`` and is 8 at most.  A window lies in one text.
    """
    reach = window // width
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    raw = np.frombuffer(b"".join([*texts, bytes(8)]), np.uint8)
    total = len(raw) - 8
    found = np.zeros(total, bool)
    # documents: (end, symbols), longest first, so that those still read come first
    end = (ends[:, None] - np.arange(width)).ravel()
    symbols = (np.maximum(lengths[:, None] - np.arange(width), 0) // width).ravel()
    order = np.argsort(-symbols, kind="stable")
    order = order[symbols[order] > 0]
    end, symbols = end[order], symbols[order]
    m = len(end)
    if not m:
        return found
    loads = np.lib.stride_tricks.as_strided(raw[:8].view(np.uint64), (total + 1,), (1,)) & KEEP[width]
    rank = np.unique(loads, return_inverse=True)[1].astype(np.uint64) << SHIFT

    kind = np.min_scalar_type(reach + 1)
    keys, common = Written(np.uint64, spool), Written(kind, spool)
    common.add(np.zeros(m, kind))
    rows = np.arange(m)  # of each document's present suffix; the first ones are the empty suffixes
    for column in range(1, int(symbols[0]) + 1):
        live = int(np.searchsorted(-symbols, -column, side="right"))
        new = rank[end[:live] - column * width] | rows[:live].astype(np.uint64)
        order = np.argsort(new)
        new = new[order]
        before = common.whole()
        keys, at, common, shift = _insert(keys, new, before, m, reach, kind, spool)
        rows = rows + shift[rows]
        rows[order] = m + at + np.arange(live)
    least, after = common.whole(), (keys.whole() & ROW).astype(np.int64)
    alike = np.maximum(least, np.append(least[1:], least[:1] * 0)) >= reach
    for column in range(int(symbols[0]), 0, -1):
        live = int(np.searchsorted(-symbols, -column, side="right"))
        if column >= reach:
            found[end[:live] - column * width] = alike[rows[:live]]
        rows[:live] = after[rows[:live] - m]
    return found


def _insert(keys: Written, new: np.ndarray, before: np.ndarray, m: int, reach: int, kind, spool: int):
    """One round: the files with the new entries, the places they took among the old ones, and how far
    each old row moves."""
    out, at = Written(np.uint64, spool), np.zeros(len(new), np.int64)
    done, seen = 0, 0  # new entries placed, old ones read
    shift = np.zeros(len(before), np.int32)
    for block in keys.blocks():
        upto = int(np.searchsorted(new, block[-1]))
        at[done:upto] = seen + np.searchsorted(block, new[done:upto])
        done, seen = upto, seen + len(block)
    at[done:] = seen
    np.cumsum(np.bincount(at, minlength=seen + 1)[:seen], out=shift[m:])

    done = seen = 0
    last, last_is_new = ~np.uint64(0), False  # the entry before
    changed, below, above = [], [], []
    for block in keys.blocks() if keys.n else [np.zeros(0, np.uint64)]:
        upto = len(new) if seen + len(block) == keys.n else int(np.searchsorted(at, seen + len(block)))
        merged = np.empty(1 + len(block) + upto - done, np.uint64)  # one more in front, for the entry before
        merged[0] = last
        places = at[done:upto] + np.arange(1 - seen, upto - done + 1 - seen)
        merged[places] = new[done:upto]
        merged[shift[m + seen : m + seen + len(block)] + np.arange(1 - done, len(block) + 1 - done, dtype=np.int32)] = block
        # a new entry and the one after it have new neighbours
        after = places + 1
        if last_is_new:
            after = np.concatenate([[1], after])
        asked = np.concatenate([places, after[after < len(merged)]])
        changed.append(asked + (done + seen - 1))
        below.append(merged[asked - 1])
        above.append(merged[asked])
        if len(merged) > 1:
            last, last_is_new = merged[-1], bool(len(places) and places[-1] == len(merged) - 1)
        moved = merged[1:]
        moved += shift[moved.view(np.uint32)[::2]].astype(np.uint64)
        out.add(moved)
        done, seen = upto, seen + len(block)

    low, high = np.concatenate(below), np.concatenate(above)
    least = np.zeros(len(low), kind)
    same = np.flatnonzero((low ^ high) <= ROW)
    least[same] = np.minimum(
        range_least(before, (low[same] & ROW).astype(np.int64) + 1, (high[same] & ROW).astype(np.int64)), reach - 1) + 1
    common = np.zeros(len(before) + len(new), kind)
    common[shift + np.arange(len(before), dtype=np.int32)] = before
    common[m + np.concatenate(changed)] = least
    prefixes = Written(kind, spool)
    prefixes.add(common)
    return out, at, prefixes, shift
