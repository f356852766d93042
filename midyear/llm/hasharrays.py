"""Sorted hash arrays: 64-bit keys counted over the corpus, written once, memory-mapped by tasks.

Tasks count the keys of their texts and send each range of keys on as one packed block; a range is
merged by one task, which writes its keys in order as a flat file in the shared folder.  The files
in range order are one sorted array, whose pages tasks map and never copy.  Work on a range grows
with its distinct keys alone: a hot key is one number per task.
"""

from __future__ import annotations

import io
import math
import mmap
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from midyear.llm.texts import frame_blocks, give_back, small_batches
from midyear.sources.shared import fresh_path

#: Keys a task gathers before it sends them on.
GATHERED = 2_000_000
#: Most frequent keys that each range names.
TOP = 32
#: Files that a task holds open per array, and the name of the file that says where each range begins.
OPEN, STARTS = 64, "starts.npy"
#: In arrays of single bytes, the sign that a row's counts stand among the large ones.
ESCAPE = 255


def shared_files(spark: SparkSession, name: str) -> str:
    """A new folder for files that tasks map: the shared folder must be mounted on all machines."""
    path = fresh_path(spark, name)
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        if scheme != "file":
            raise RuntimeError(f"memory-mapped arrays need a mounted spark.checkpoint.dir, not {scheme}")
        path = "/" + rest.lstrip("/")
    os.makedirs(path, exist_ok=True)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Executions started within let their shuffle files go when they end, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def save(path: str, array: np.ndarray) -> None:
    """Write whole or not at all, so that a task may run again at any time."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        np.save(file, np.ascontiguousarray(array))
    os.replace(part, path)


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts as the smallest whole numbers that hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def save_counts(path: str, counts: np.ndarray) -> None:
    """One byte a count; rows with a count of 255 or more go to a second file with their places."""
    rows = counts.reshape(len(counts), -1)
    large = np.flatnonzero((rows >= ESCAPE).any(axis=1))
    if len(large):
        save(path.replace(".counts.", ".large."), np.column_stack([large, rows[large]]).astype(np.int64))
    small = np.minimum(counts, ESCAPE).astype(np.uint8)
    small[large] = ESCAPE
    save(path, small)


def in_32_bits(values: np.ndarray) -> np.ndarray:
    """Counts or numbers as they travel; larger ones fail instead of being cut."""
    if len(values) and int(values.max()) >> 32:
        raise OverflowError(f"{int(values.max())} does not fit in 32 bits")
    return values.astype(np.uint32)


def shards_for(docs: DataFrame, least: int = 16) -> int:
    """A power of two: at least twice as many ranges as the input has partitions."""
    return max(least, 1 << (2 * docs.rdd.getNumPartitions() - 1).bit_length())


def range_of(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    return (keys >> np.uint64(65 - n_ranges.bit_length())).astype(np.int64)


def small_argsort(numbers: np.ndarray, n: int) -> np.ndarray:
    """The stable order of numbers below ``n``; short numbers are sorted in linear time."""
    return np.argsort(numbers.astype(np.uint16) if n <= 1 << 16 else numbers, kind="stable")


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and for each key its place among them."""
    line = np.argsort(keys)
    new = np.concatenate([[True], keys[line[1:]] != keys[line[:-1]]]) if len(keys) else np.zeros(0, bool)
    back = np.empty(len(keys), np.int64)
    back[line] = np.cumsum(new) - 1
    return keys[line[new]], back


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with how often each stands."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def count_keys(
    docs: DataFrame,
    keys_of: Callable[[list[bytes | None]], np.ndarray],
    folder: str,
    n_ranges: int,
    least: int = 1,
    text: str = "text",
) -> pd.DataFrame:
    """Write keys and counts of all texts to ``folder``; ``least`` leaves out keys counted less often.

    Returns one row per range: range_no, n_keys, total, and the places and counts of its
    most frequent keys (``TOP`` at most).
    """

    def blocks(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        cuts = np.searchsorted(range_of(keys, n_ranges), np.arange(n_ranges + 1))
        rows = [
            (k, keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes())
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b
        ]
        return pd.DataFrame(rows, columns=["range_no", "keys", "counts"])

    def gather(frames: Iterator[pd.DataFrame]):
        held, size = [], 0
        for frame in (block for frame in frames for block in frame_blocks(frame)):
            keys = keys_of(frame["raw"].tolist())
            held.append(_distinct(keys))
            size += len(held[-1][0])
            if size > GATHERED:
                held = [add_up(*map(np.concatenate, zip(*held)))]
                if len(held[0][0]) > GATHERED // 2:
                    yield blocks(*held.pop())
                size = sum(len(k) for k, _ in held)
        if held:
            yield blocks(*add_up(*map(np.concatenate, zip(*held))))
            held.clear()
        give_back()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        give_back()
        number = int(frame["range_no"].iloc[0])
        keys, counts = add_up(
            np.concatenate([np.frombuffer(b, np.uint64) for b in frame["keys"]]),
            np.concatenate([np.frombuffer(b, np.uint32) for b in frame["counts"]]).astype(np.int64))
        kept = counts >= least
        keys, counts = keys[kept], counts[kept]
        save(f"{folder}/{number:06d}.keys.npy", keys)
        save(f"{folder}/{number:06d}.counts.npy", narrow(counts))
        top = np.sort(np.argsort(counts)[-TOP:])
        return pd.DataFrame({"range_no": [number], "n_keys": [len(keys)], "total": [int(counts.sum())],
                             "top": [top.tolist()], "top_counts": [counts[top].tolist()]})

    small_batches(docs.sparkSession)
    sent = docs.select(F.col(text).cast("binary").alias("raw")).mapInPandas(
        gather, "range_no int, keys binary, counts binary")
    merged = sent.groupBy("range_no").applyInPandas(
        merge, "range_no int, n_keys long, total long, top array<long>, top_counts array<long>")
    found = merged.toPandas().sort_values("range_no", ignore_index=True)  # one row a range
    sizes = np.zeros(n_ranges, np.int64)
    sizes[found["range_no"]] = found["n_keys"]
    save(f"{folder}/{STARTS}", np.concatenate([[0], np.cumsum(sizes)]))
    return found


class Mapped:
    """Arrays of a folder's files, mapped when they are asked for; at most ``OPEN`` files are held open."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def get(self, path: str) -> np.ndarray | None:
        """The array in ``path``, or None where no task had anything to write."""
        found = self.held.pop(path, None)
        if found is None:
            try:
                found = _mapped(path)
            except FileNotFoundError:
                return None
            while len(self.held) >= OPEN:
                del self.held[next(iter(self.held))]  # the one not asked for the longest
        self.held[path] = found
        return found


class HashArray:
    """The arrays of a folder, read in a task range by range.

    Places count through all ranges where ``count_keys`` wrote the folder, else within their range.
    ``bytes`` says that ``save_counts`` wrote the counts.
    """

    def __init__(self, folder: str, n_ranges: int, width: tuple[int, ...] = (), bytes: bool = False):
        self.folder, self.n_ranges, self.width, self.bytes = folder, n_ranges, width, bytes
        self.files = Mapped()
        self.starts = np.load(f"{folder}/{STARTS}") if os.path.exists(f"{folder}/{STARTS}") else None

    def _range(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        keys = self.files.get(f"{self.folder}/{k:06d}.keys.npy")
        if keys is None:
            return np.zeros(0, np.uint64), np.zeros((0, *self.width), np.int64)
        return keys, self.files.get(f"{self.folder}/{k:06d}.counts.npy")

    def _large(self, k: int, at: np.ndarray, count: np.ndarray, there: np.ndarray) -> None:
        """Put in the counts that are too large for a byte."""
        marked = np.flatnonzero(count[there].reshape(len(there), -1)[:, 0] == ESCAPE) if len(there) else there
        if len(marked):
            large = self.files.get(f"{self.folder}/{k:06d}.large.npy")
            count[there[marked]] = large[np.searchsorted(large[:, 0], at[marked]), 1:].reshape(len(marked), *self.width)

    def counts_at(self, places: np.ndarray) -> np.ndarray:
        """Counts of keys by their places."""
        asked, back = np.unique(places, return_inverse=True)
        out = np.empty(len(asked), np.int64)
        cuts = np.searchsorted(asked, self.starts)
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            out[cuts[k] : cuts[k + 1]] = self._range(k)[1][asked[cuts[k] : cuts[k + 1]] - self.starts[k]]
        return out[back]

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where stored keys may repeat: all rows of all keys, and of each row the place of its key in ``keys``."""
        order = np.argsort(keys)
        asked = keys[order]
        cuts = np.searchsorted(range_of(asked, self.n_ranges), np.arange(self.n_ranges + 1))
        at, rows = [np.zeros(0, np.int64)], [np.zeros((0, *self.width), np.int64)]
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            part, (stored, counts) = slice(cuts[k], cuts[k + 1]), self._range(k)
            low = np.searchsorted(stored, asked[part])
            n = np.searchsorted(stored, asked[part], side="right") - low
            who = np.repeat(np.arange(len(n)), n)
            at.append(order[part][who])
            rows.append(counts[low[who] + np.arange(len(who)) - (np.cumsum(n) - n)[who]])
        return np.concatenate(at), np.concatenate(rows)

    def find(self, keys: np.ndarray, ranges: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key in the whole array, or -1, and its count (or row of counts), or 0.

        ``ranges`` names the range of each key where the key alone does not.
        """
        line = np.argsort(keys)
        new = np.concatenate([[True], keys[line[1:]] != keys[line[:-1]]]) if len(keys) else np.zeros(0, bool)
        index, back = line[new], np.empty(len(keys), np.int64)
        back[line] = np.cumsum(new) - 1
        asked = keys[index]
        if ranges is None:  # in their order already
            where, order = range_of(asked, self.n_ranges), np.arange(len(asked))
        else:
            order = small_argsort(ranges[index], self.n_ranges)
            asked, where = asked[order], ranges[index][order]
        place = np.full(len(asked), -1, np.int64)
        count = np.zeros((len(asked), *self.width), np.int64)
        cuts = np.searchsorted(where, np.arange(self.n_ranges + 1))
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            rows, (stored, counts) = slice(cuts[k], cuts[k + 1]), self._range(k)
            if len(stored):
                at = np.minimum(np.searchsorted(stored, asked[rows]), len(stored) - 1)
                there = np.flatnonzero(stored[at] == asked[rows]) + cuts[k]
                place[there] = at[there - cuts[k]] + (0 if self.starts is None else self.starts[k])
                count[there] = counts[at[there - cuts[k]]]
                if self.bytes:
                    self._large(k, at[there - cuts[k]], count, there)
        spot = np.empty(len(order), np.int64)
        spot[order] = np.arange(len(order))
        return place[spot[back]], count[spot[back]]


def _mapped(path: str) -> np.ndarray:
    # a plain array over the mapped file, opened without numpy's own parsing of each header: tasks open many
    with open(path, "rb") as file:
        head = file.read(10)
        head += file.read(int.from_bytes(head[8:10], "little"))
        shape, kind = _header(head)
        if not math.prod(shape):
            return np.zeros(shape, kind)
        whole = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    return np.frombuffer(whole, kind, math.prod(shape), len(head)).reshape(shape)


@lru_cache(maxsize=1 << 14)
def _header(head: bytes) -> tuple[tuple[int, ...], np.dtype]:
    """Shape and kind of an array that ``save`` wrote."""
    stream = io.BytesIO(head)
    if np.lib.format.read_magic(stream) != (1, 0):
        raise ValueError("no array of this version")
    shape, by_column, kind = np.lib.format.read_array_header_1_0(stream)
    if by_column and len(shape) > 1:
        raise ValueError("columns are not mapped")
    return shape, kind
