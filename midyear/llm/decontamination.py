"""Benchmark passages found in training documents through an FM-index of each training shard.

A task cuts its documents into shards of about ``shard_words`` words (a longer document into
overlapping pieces), builds an FM-index over the words of a shard, searches all benchmark
windows backward through its wavelet tree, locates each occurrence by sampled suffix positions
and merges the covered words of each document into removal spans.  No shuffle is needed: an
occurrence lies within one document.

The benchmark is read in blocks of at most about ``block_bytes`` of text; each block is one pass
over the documents and its windows are sent to the tasks.  Words and windows are those of the
contract: A-Z lowered, runs of letters, digits and characters beyond ASCII; ``window``
consecutive words, or the whole item if it has fewer.  Null texts have no words and no hits;
items without words never occur; a null item id counts as the empty id; repeated items count once.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.llm.fmindex import FMIndex
from midyear.llm.texts import map_texts
from midyear.sources.shared import cut_lineage

RUN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TABLE = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32
    for c in range(256)
)
SPANS = "array<struct<start:int,stop:int>>"


def plain_words(raw: bytes | None) -> list[bytes]:
    return raw.translate(TABLE).split() if raw else []


class Windows:
    """The distinct windows of a block of items, as numbers into their distinct words."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        owners: dict[tuple, set[str]] = {}
        for item, raw in items:
            words = plain_words(raw)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i : i + window]), set()).add(item)
        self.words = sorted({word for key in owners for word in key})
        place = {word: i for i, word in enumerate(self.words)}
        self.numbers = np.zeros((len(owners), window), np.int64)
        self.lengths = np.array([len(key) for key in owners], np.int64)
        for row, key in zip(self.numbers, owners):
            row[window - len(key):] = [place[word] for word in key]
        self.items = [sorted(found) for found in owners.values()]

    def occurrences(self, pieces: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece, first word, window) of each occurrence in a shard."""
        flat = [word for words in pieces for word in words]
        distinct = dict(zip(dict.fromkeys(flat), range(1 + len(pieces), 2**62)))
        words = np.fromiter(map(distinct.__getitem__, flat), np.int64, len(flat))
        # 0, then each piece behind a mark of its own: nothing is found across pieces
        lengths = np.array([len(p) for p in pieces], np.int64)
        starts = 2 + np.arange(len(pieces)) + np.cumsum(lengths) - lengths
        text = np.zeros(1 + len(pieces) + len(words), np.int64)
        text[starts - 1] = 1 + np.arange(len(pieces))
        inside = np.ones(len(text), bool)
        inside[0] = False
        inside[starts - 1] = False
        text[inside] = words
        known = np.array([distinct.get(word, -1) for word in self.words], np.int64)
        patterns = known[self.numbers]
        unused = np.arange(patterns.shape[1])[None, :] < (patterns.shape[1] - self.lengths)[:, None]
        tried = np.flatnonzero(((patterns >= 0) | unused).all(axis=1))
        if not len(tried):
            return (np.zeros(0, np.int64),) * 3
        index = FMIndex(text, 1 + len(pieces) + len(distinct))
        index.drop_order()
        low, high = index.search(patterns[tried], self.lengths[tried])
        counts = high - low
        which = np.repeat(tried, counts)
        rows = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = index.locate(rows)
        piece = np.searchsorted(starts, at, side="right") - 1
        return piece, at - starts[piece], which


def merge_spans(starts: np.ndarray, stops: np.ndarray) -> list[dict]:
    """Disjoint spans in order that cover the same words."""
    out: list[dict] = []
    for start, stop in sorted(zip(starts.tolist(), stops.tolist())):
        if out and start <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], stop)
        else:
            out.append({"start": start, "stop": stop})
    return out


def _shards(texts: list[bytes | None], shard_words: int, overlap: int):
    """Lists of (text number, first word, words); a text is never left out or cut without overlap."""
    shard, size = [], 0
    for i, raw in enumerate(texts):
        words = plain_words(raw)
        for first in range(0, max(1, len(words) - overlap), shard_words):
            piece = words[first : first + shard_words + overlap]
            shard.append((i, first, piece))
            size += len(piece)
            if size >= shard_words:
                yield shard
                shard, size = [], 0
    if shard:
        yield shard


def find_in_texts(texts: list[bytes | None], windows: Windows, shard_words: int) -> dict:
    n_words, spans, items = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
    found: dict[int, list] = {}
    width = windows.numbers.shape[1]
    for shard in _shards(texts, shard_words, width - 1):
        for i, first, words in shard:
            n_words[i] = max(n_words[i], first + len(words))
        if not len(windows.items):
            continue
        piece, first, which = windows.occurrences([words for _, _, words in shard])
        for p, f, w in zip(piece.tolist(), first.tolist(), which.tolist()):
            i, begin, _ = shard[p]
            found.setdefault(i, []).append((begin + f, w))
    for i, hits in found.items():
        starts, which = np.array(hits, np.int64).T
        spans[i] = merge_spans(starts, starts + windows.lengths[which])
        items[i] = sorted({item for w in set(which.tolist()) for item in windows.items[w]})
    return {"n_words": n_words, "spans": spans, "items": items}


def _merged(spans: Column) -> Column:
    """Words covered by sorted spans that may overlap."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    step = lambda acc, s: F.struct(
        (acc.n + F.greatest(F.lit(0), s.stop - F.greatest(s.start, acc.upto))).alias("n"),
        F.greatest(acc.upto, s.stop).alias("upto"))
    return F.aggregate(spans, zero, step, lambda acc: acc.n)


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    window: int = 10,
    shard_words: int = 1_000_000,
    block_bytes: int = 4_000_000,
) -> DataFrame:
    """Columns ``carry`` with ``n_words``, ``n_hit``, ``spans`` (words) and ``items`` (sorted ids)."""
    bench = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.col("text").cast("binary").alias("raw")).distinct()  # copies of an item would share a block
    size = bench.agg(F.sum(F.length("raw"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text"))
    spans, items = [], []
    for k in range(n_blocks):
        block = bench.filter(F.abs(F.hash("item", "raw") % n_blocks) == k)
        windows = Windows([tuple(r) for r in block.collect()], window)  # within the block's bound

        def work(batches, windows=windows):
            for texts in batches:
                found = find_in_texts(texts, windows, shard_words)
                yield {name if name == "n_words" else f"{name}_{k}": v for name, v in found.items()}

        last = k == n_blocks - 1
        kept = ["row"] + ([] if last else ["text"]) + spans + items
        rows = map_texts(rows, work, f"n_words bigint, spans_{k} {SPANS}, items_{k} array<string>", tuple(kept))
        spans.append(f"spans_{k}")
        items.append(f"items_{k}")
        if not last:
            rows = cut_lineage(rows)
    every = F.array_sort(F.flatten(F.array(*spans)))
    ids = F.array_sort(F.array_distinct(F.flatten(F.array(*items))))
    rows = rows.select("row", "n_words", every.alias("spans"), ids.alias("items"))
    return rows.select("row.*", "n_words", _merged(F.col("spans")).cast("long").alias("n_hit"), "spans", "items")


def without_spans(raw: bytes, spans: list) -> bytes:
    """The text without the covered words; what stands between them goes with them."""
    runs = [m.span() for m in RUN.finditer(raw)]
    out, upto = [], 0
    for start, stop in spans:
        begin, end = runs[start][0], runs[stop - 1][1]
        if begin > upto:
            out.append(raw[upto:begin])
        upto = max(upto, end)
    return b"".join([*out, raw[upto:]])


def remove_spans(rows: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Columns ``carry`` and ``cleaned``: the ``text`` without the words that ``spans`` covers."""

    def work(batches):
        for texts, found in batches:
            yield {"cleaned": [
                without_spans(raw, [(s["start"], s["stop"]) for s in spans]) if spans else raw
                for raw, spans in zip(texts, found)
            ]}

    made = map_texts(rows, work, "cleaned binary", carry, beside="spans")
    return made.withColumn("cleaned", F.col("cleaned").cast("string"))
