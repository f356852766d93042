"""Shared helpers: text batches inside tasks, and ordered hashes of document ids.

A word is a run of bytes other than space and ``\\x09``-``\\x0D``, which is what
``bytes.split`` cuts at; ``bytes.lower`` lowers A-Z alone.  Texts travel as UTF-8 bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
#: Which bytes words consist of; masks of the lowest bytes; bytes after which a word is hashed whole.
IN_WORD = np.array([c != 0x20 and not 0x09 <= c <= 0x0D for c in range(256)])
KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_WORD = 256
#: Bytes of text that a task works on at once, and bytes of rows in a batch on its way there.
BLOCK_BYTES = 4_000_000
BATCH_BYTES = 8_000_000


def give_back() -> None:
    """Return what a task has freed to the machine: workers live on, side by side with others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Let batches of rows go to Python by ``BATCH_BYTES`` where the session has Spark's default of 64 MB.

    Executors hold a batch several times over on its way, so long texts need a lower bound.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, str(BATCH_BYTES))


def map_texts(
    docs: DataFrame,
    work: Callable[[Iterator[list[bytes | None]]], Iterator[dict]],
    made: str,
    carry: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    beside: str | None = None,
) -> DataFrame:
    """Columns ``carry`` of every row, and the columns ``made`` that ``work`` finds for its text.

    ``work`` is made once per task and gets the texts block by block; it yields as many
    values per column as it got texts.  Carried columns travel in one struct, so their
    names cannot clash with others; a made column takes the place of a carried one.  With
    ``beside``, ``work`` gets pairs of the texts and the values of that column.
    """
    fresh = T._parse_datatype_string(made)
    kept = [name for name in carry if name not in fresh.names]
    row = T.StructType([docs.schema[name] for name in kept])
    schema = T.StructType([T.StructField("row", row)] + fresh.fields)

    def run(batches):
        held = []

        def texts():
            for batch in batches:
                for a, b in text_blocks(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()):
                    held.append(batch.slice(a, b - a))
                    texts = held[-1].column(1).to_pylist()
                    yield texts if beside is None else (texts, held[-1].column(2).to_pylist())

        for out in work(texts()):
            batch = held.pop(0)
            columns = [pa.array(out[f.name], type=_arrow(f.dataType)) for f in fresh.fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", *fresh.names])
            batch = columns = out = None
        give_back()

    small_batches(docs.sparkSession)
    inner = F.struct(*[F.col(_quoted(name)) for name in kept]) if kept else F.struct(F.lit(0))
    if not kept:
        schema = T.StructType([T.StructField("row", T.StructType([T.StructField("col1", T.IntegerType())]))] + fresh.fields)
    more = [] if beside is None else [F.col(_quoted(beside)).alias("beside")]
    sent = docs.select(inner.alias("row"), F.col(text).cast("binary").alias("raw"), *more)
    out = sent.mapInArrow(run, schema)
    return out.select(*[F.col(f"row.{_quoted(name)}") for name in kept], *fresh.names)


def text_blocks(sizes: np.ndarray, most: int = BLOCK_BYTES) -> list[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` bytes; a longer text is one by itself."""
    block = np.cumsum(sizes.astype(np.int64)) // most
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])).tolist() if len(sizes) else []
    return list(zip(cuts, [*cuts[1:], len(sizes)]))


def frame_blocks(frame, column: str = "raw"):
    """The rows of a pandas frame in blocks, by the bytes of ``column``."""
    sizes = np.array([len(raw) if raw is not None else 0 for raw in frame[column]], np.int64)
    for a, b in text_blocks(sizes):
        yield frame.iloc[a:b]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class Words:
    """The words of a block of texts as numbers, found and hashed without an object per word.

    ``hashes``, ``starts`` and ``ends`` (bytes in ``raw``) are per word; ``first`` says at which
    word each text begins, and ``offsets`` at which byte.
    """

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        parts = [raw or b"" for raw in texts]
        self.raw = b"".join([b"\n", b"\n".join(parts), b"\n", bytes(8)])
        if lower:
            self.raw = self.raw.lower()
        self.bytes = np.frombuffer(self.raw, np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.offsets = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])
        inside = IN_WORD[self.bytes[:-8]]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        """Eight bytes at a time; words of up to eight bytes have different hashes for sure."""
        sizes = self.ends - self.starts
        eights = np.lib.stride_tricks.as_strided(self.bytes[:8].view(np.uint64), (len(self.raw) - 7,), (1,))
        hashes, live, at = sizes.astype(np.uint64), np.arange(len(sizes)), 0
        while len(live):
            left = np.minimum(sizes[live] - at, 8)
            chunk = eights[self.starts[live] + at] & KEEP[left]
            hashes[live] = mix(chunk, hashes[live])
            at += 8
            live = live[sizes[live] > at]
            if at >= LONG_WORD:
                for i in live.tolist():
                    hashes[i] = xxhash.xxh64_intdigest(self.raw[self.starts[i] : self.ends[i]])
                break
        return hashes

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each line with words: its text, its place there, and its first word."""
        breaks = np.flatnonzero(self.bytes == 10)
        line = np.searchsorted(breaks, self.starts)
        head = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
        owner = np.searchsorted(self.first, head, side="right") - 1
        return owner, line[head] - np.searchsorted(breaks, self.offsets[owner]), head


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit numbers (multiply and shift, wrapping)."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def id_text(column: Column) -> Column:
    """A document id as text; a null id counts as the empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def fold(column: Column, parts: int) -> Column:
    """crc32 of a document id as text, modulo ``parts``."""
    return F.crc32(id_text(column).cast("binary")) % parts
