"""Repeated byte passages, found by building Burrows-Wheeler transforms column by column.

Every window of ``window`` bytes is owned by its anchor: its ``gram`` bytes with the least hash, the
first of equal ones.  Equal windows have equal anchors, so the stretch of windows that share one is a
segment, and the segments of an anchor make up one shard with those of others.  Anchors that occur once
in the corpus cannot own a repeated window; the others are kept as a sorted hash array that tasks map.
Equal segments are counted, not repeated.  A shard builds the transform and the common prefixes of its
segments (``columns``): a window repeats if a neighbouring suffix shares that many bytes, or if its
segment is counted twice or more.  Each occurrence is removed.

An anchor with one distinct segment has nothing to be compared with; no window stands twice in a segment,
as its anchor would stand there twice too.  An anchor with more than ``hot_segments`` distinct segments is
split by longer anchors, at last by whole windows, so no shard grows with the copies of a passage.

Null texts are empty; repeated rows are documents each, so their windows repeat; texts without a
repeated window, also those shorter than a window, are kept whole; a text of any length is cut by its
own spans.  An empty table gives no rows.  Columns besides ``carry`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from midyear.llm.columns import repeated_starts
from midyear.llm.hasharrays import HashArray, count_keys, shards_for, shared_files
from midyear.llm.texts import KEEP, frame_blocks, give_back, map_texts, mix
from midyear.sources.shared import cut_lineage

#: Places that fit below a hash, and windows looked at together.
PLACE_BITS = 24
SLICE = 1 << 22
#: Multipliers of the rolled-up hash, by the bytes it covers.
ODD = np.uint64(0x9E3779B97F4A7C15)


def _grams(loads: np.ndarray, size: int) -> np.ndarray:
    """A sum over each ``size`` consecutive bytes, from loads of eight bytes at every byte."""
    if size <= 8:
        return loads & KEEP[size]
    half = size // 2
    inner, n = _grams(loads, half), len(loads) - size + 1
    out = inner[:n] * (ODD ^ np.uint64(size << 1))
    out += inner[half : half + n]
    if size % 2:
        out *= ODD
        out += loads[size - 1 : size - 1 + n] & KEEP[1]
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from running minima of blocks, both ways."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments_of(texts: list[bytes | None], window: int, gram: int):
    """The joined texts, and of each segment: text, first byte, last window's first byte, anchor's hash."""
    parts = [raw or b"" for raw in texts]
    joined = b"".join([*parts, bytes(8)])
    data = np.frombuffer(joined, np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes) - sizes
    n = len(data) - 8 - window + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return joined, starts, none, none, none, np.zeros(0, np.uint64)
    valid = np.zeros(n + 2, bool)  # by the window's first byte, one place on
    for start, size in zip(starts.tolist(), sizes.tolist()):
        valid[start + 1 : max(start, start + size - window + 1) + 1] = True
    place = np.uint64((1 << PLACE_BITS) - 1)
    out = []
    for low in range(0, n, SLICE):
        upto = min(n, low + SLICE)
        part = data[low : upto + window - 1 + 8]
        loads = np.lib.stride_tricks.as_strided(part[:8].view(np.uint64), (len(part) - 8,), (1,))
        hashes = _grams(loads, gram)[: len(loads) - gram + 1]
        hashes = mix(hashes, hashes)
        ranked = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        least = _least(ranked, window - gram + 1)
        here = valid[low + 1 : upto + 1]
        new = np.ones(len(least) + 1, bool)
        new[1:-1] = least[1:] != least[:-1]
        before, behind = valid[low:upto].copy(), valid[low + 2 : upto + 2].copy()
        before[0] = behind[-1] = False
        first = np.flatnonzero(here & (new[:-1] | ~before))
        last = np.flatnonzero(here & (new[1:] | ~behind))
        out.append((first + low, last + low, hashes[(least[first] & place).astype(np.int64)]))
    first, last, keys = map(np.concatenate, zip(*out))
    owner = np.searchsorted(starts, first, side="right") - 1
    return joined, starts, owner, first, last, keys


def spans_in(segments: list[bytes], counts: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """For each segment, the spans of bytes covered by windows that stand elsewhere too."""
    width = next(w for w in (8, 7, 6, 5, 4, 3, 2, 1) if window % w == 0)
    starts = repeated_starts(segments, window, width)
    out, at = [], 0
    for raw, n in zip(segments, counts):
        if n > 1:
            out.append([(0, len(raw))])
        else:
            hits = np.flatnonzero(starts[at : at + len(raw)])
            gaps = np.flatnonzero(np.diff(hits) > window)
            low, high = np.append(hits[:1], hits[gaps + 1]), np.append(hits[gaps], hits[-1:])
            out.append([(a, b + window) for a, b in zip(low.tolist(), high.tolist())])
        at += len(raw)
    return out


def passage_spans(
    docs: DataFrame, window: int, grams: tuple[int, ...], shard_bytes: int, hot_segments: int,
) -> DataFrame:
    """``doc_id, text_hash, spans`` of the documents with repeated windows."""
    n_ranges, folder = shards_for(docs), shared_files(docs.sparkSession, "byte-anchors")
    count_keys(docs, lambda texts: segments_of(texts, window, grams[0])[-1], folder, n_ranges, least=2)

    def cut(batches):
        repeated = HashArray(folder, n_ranges)
        for texts in batches:
            joined, starts, owner, first, last, keys = segments_of(texts, window, grams[0])
            kept = np.flatnonzero(repeated.find(keys)[0] >= 0)
            out, seen = [[] for _ in texts], set()
            for i, key, a, b in zip(owner[kept].tolist(), keys.view(np.int64)[kept].tolist(),
                                    first[kept].tolist(), last[kept].tolist()):
                piece = joined[a : b + window]
                digest = xxhash.xxh3_128_digest(piece)
                out[i].append({"anchor": key, "digest": digest, "start": a - int(starts[i]), "size": len(piece),
                               "bytes": None if digest in seen else piece})
                seen.add(digest)
            yield {"found": out, "text_hash": [xxhash.xxh3_128_digest(raw or b"") for raw in texts]}

    found = map_texts(
        docs, cut, "text_hash binary, found array<struct<anchor:bigint,digest:binary,start:bigint,size:int,bytes:binary>>")
    found = cut_lineage(found.select("doc_id", "text_hash", F.inline("found")))

    def shorter(gram: int):
        def split(frames: Iterator[pd.DataFrame]):
            for frame in (block for whole in frames for block in frame_blocks(whole, "bytes")):
                joined, starts, owner, first, last, keys = segments_of(frame["bytes"].tolist(), window, gram)
                pieces = [joined[a : b + window] for a, b in zip(first.tolist(), last.tolist())]
                above = frame["anchor"].to_numpy(np.int64)[owner].view(np.uint64)
                yield pd.DataFrame({
                    "digest": frame["digest"].to_numpy()[owner], "shift": first - starts[owner],
                    "anchor": mix(keys, above).view(np.int64), "n": frame["n"].to_numpy()[owner],
                    "piece": [xxhash.xxh3_128_digest(p) for p in pieces], "bytes": pieces})
                give_back()

        return split

    rows, weight = found.select("anchor", "digest", "size", "bytes", F.lit(1).cast("bigint").alias("n")), 0
    shards, split = [], []
    for gram in grams[1:] + (None,):
        sizes = cut_lineage(rows.select("anchor", "digest", "size").distinct().groupBy("anchor").agg(
            F.count(F.lit(1)).alias("distinct"), F.sum("size").alias("size")))
        hot = sizes.filter(F.col("distinct") > (hot_segments if gram else 2**62))
        weight += sizes.agg(F.sum("size")).first()[0] or 0
        if hot.isEmpty():
            shards.append(_counted(rows))
            break
        hot = cut_lineage(hot.select("anchor"))
        shards.append(_counted(rows.join(hot, "anchor", "left_anti")))
        parts = cut_lineage(_counted(rows.join(hot, "anchor", "left_semi")).mapInPandas(
            shorter(gram), "digest binary, shift bigint, anchor bigint, n bigint, piece binary, bytes binary"))
        split.append(parts.select("digest", "shift", "piece"))
        rows = parts.select("anchor", F.col("piece").alias("digest"), F.length("bytes").alias("size"), "bytes", "n")

    n_shards = max(1, weight // shard_bytes)

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame["anchor"].to_numpy()
        _, which, distinct = np.unique(own, return_inverse=True, return_counts=True)
        alone = frame[distinct[which] == 1]  # nothing to compare with: all windows repeat, or none
        rows = [(d, 0, len(raw)) for d, raw, n in zip(alone["digest"], alone["bytes"], alone["n"]) if n > 1]
        frame = frame[distinct[which] > 1]
        spans = spans_in(frame["bytes"].tolist(), frame["n"].to_numpy(), window)
        rows += [(d, a, b) for d, some in zip(frame["digest"], spans) for a, b in some]
        give_back()
        return pd.DataFrame(rows, columns=["digest", "first", "upto"])

    dealt = _union(shards).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(n_shards)))
    matched = cut_lineage(dealt.groupBy("shard").applyInPandas(search, "digest binary, first bigint, upto bigint"))
    for parts in reversed(split):  # from pieces back to the segments they were cut from
        up = parts.join(matched.withColumnRenamed("digest", "piece"), "piece").select(
            "digest", (F.col("shift") + F.col("first")).alias("first"), (F.col("shift") + F.col("upto")).alias("upto"))
        matched = matched.union(up)
    met = found.select("doc_id", "text_hash", "digest", "start").join(matched, "digest")
    return met.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(
        (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("upto")).alias("stop"))).alias("spans"))


def _counted(rows: DataFrame) -> DataFrame:
    """Distinct segments with how often they stand."""
    return rows.groupBy("anchor", "digest").agg(
        F.first("bytes", ignorenulls=True).alias("bytes"), F.sum("n").alias("n"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def without_passages(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    window: int = 200,
    grams: tuple[int, ...] = (64, 128),
    shard_bytes: int = 400_000,
    hot_segments: int = 2048,
) -> DataFrame:
    """Columns ``carry`` with ``n_bytes, n_removed, n_spans, removed`` (start and stop of each run of bytes),
    ``kept_sha256`` and ``kept`` (the bytes left).  Runs jobs.

    ``grams`` are the lengths of anchors, from that of the first segments to those that split hot ones; a
    whole window is the last.
    """
    found = passage_spans(docs.select("doc_id", "text"), window, (*grams, window), shard_bytes, hot_segments)

    def hashed(batches):
        for texts in batches:
            yield {"text_hash": [xxhash.xxh3_128_digest(raw or b"") for raw in texts]}

    def clean(batches):
        for texts, spans in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "removed": [], "kept_sha256": [], "kept": []}
            for raw, some in zip(texts, spans):
                raw, runs, kept, upto = raw or b"", [], [], 0
                for start, stop in sorted((s["start"], s["stop"]) for s in some or []):
                    if runs and start <= runs[-1]["stop"]:
                        runs[-1]["stop"] = max(runs[-1]["stop"], stop)
                    else:
                        runs.append({"start": start, "stop": stop})
                for run in runs:
                    kept.append(raw[upto : run["start"]])
                    upto = run["stop"]
                left = b"".join([*kept, raw[upto:]])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(left))
                out["n_spans"].append(len(runs))
                out["removed"].append(runs)
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["kept"].append(left)
            yield out

    rows = docs.select(F.struct(*dict.fromkeys(carry)).alias("row"), "doc_id", "text")
    rows = map_texts(rows, hashed, "text_hash binary", ("row", "doc_id", "text"))
    named = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    met = rows.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    made = ("n_bytes bigint, n_removed bigint, n_spans bigint, removed array<struct<start:bigint,stop:bigint>>, "
            "kept_sha256 string, kept binary")
    return map_texts(met, clean, made, ("row",), beside="spans").select(
        "row.*", "n_bytes", "n_removed", "n_spans", "removed", "kept_sha256", "kept")
