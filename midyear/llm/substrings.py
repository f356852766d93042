"""Repeated passages found by matching statistics over a compressed FM-index of each shard.

Every window of ``window`` words is owned by its anchor: its ``gram`` words with the least hash.
Equal windows have equal anchors, so consecutive windows with one anchor make a segment, and the
segments of an anchor make up one shard with those of others.  Anchors that occur once in the
corpus cannot own a repeated window; the others are kept as a sorted hash array that tasks map.
A shard builds an FM-index over its distinct segments and streams each of them backward through
the wavelet trees, holding the rows that match the last ``window`` words: once the match is that
long, the rows widen to their parent, all that share those words, by a bit vector of the parents at
that depth, which is found from the wavelet trees too; the sorted suffixes go once the index is built.
A window whose rows stand for two occurrences or more is repeated; each of its occurrences is removed.

Copies of a segment are counted before they reach a shard.  The spans found lie in mapped arrays by the
digests of segments; each text's segments are made once more to look theirs up, so texts are never sent
from task to task.  An anchor with more than ``hot_segments``
distinct segments is spread: its segments go on window by window, each dealt by its own words.
Null texts have no words; repeated rows are documents each, so their windows repeat.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from midyear.llm.fmindex import FMIndex
from midyear.llm.hasharrays import HashArray, count_keys, save, shards_for, shared_files
from midyear.llm.texts import Words, frame_blocks, give_back, map_texts, mix, small_batches
from midyear.sources.shared import cut_lineage

#: Segments that a task remembers to have sent on with their words.
SENT = 100_000


def runs_of_anchors(hashes: np.ndarray, starts: np.ndarray, window: int, gram: int):
    """Runs of windows with one anchor: first window, last window and the anchor's hash.

    ``starts`` says where each text begins among ``hashes``; a window lies in one text.
    """
    n = len(hashes) - window + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = _grams(hashes, gram)
    # the place of the first least gram in each window, by doubling the span looked at
    span, place = 1, np.arange(len(grams))
    width = window - gram + 1
    while span < width:
        step = min(span, width - span)
        a, b = place[:-step], place[step:]
        place = np.where(grams[b] < grams[a], b, a)
        span += step
    place = place[:n]
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    valid = text[:n] == text[window - 1 :]
    first = np.flatnonzero(valid & np.concatenate([[True], (place[1:] != place[:-1]) | ~valid[:-1]]))
    last = np.flatnonzero(valid & np.concatenate([(place[1:] != place[:-1]) | ~valid[1:], [True]]))
    return first, last, grams[place[first]]


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive numbers."""
    if size == 1:
        return hashes
    half = size // 2
    inner = _grams(hashes, half)
    n = len(hashes) - size + 1
    if size % 2 == 0:
        return mix(inner[:n], inner[half : half + n])
    return mix(mix(inner[:n], inner[half : half + n]), hashes[size - 1 :])


def segment_spans(segments: list[bytes], counts: np.ndarray, places: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """For each segment, the spans of words covered by windows with two occurrences or more.

    A segment that occurs twice is such a span as a whole.  Equal windows have equal places, so a segment
    alone at its place shares no window; where some occur once beside others, the index holds all of the
    place and those that occur once are streamed.
    """
    _, group = np.unique(places, return_inverse=True)
    once = counts == 1
    mixed = (np.bincount(group) > 1) & (np.bincount(group, once) > 0)
    held = np.flatnonzero(mixed[group])
    out = [[] if alone else [(0, segment.count(b" ") + 1)] for segment, alone in zip(segments, once.tolist())]
    if not len(held):
        return out
    words = [segments[i].split(b" ") for i in held.tolist()]
    flat = [word for some in words for word in some]
    numbers = dict(zip(dict.fromkeys(flat), range(1 + len(words), 2**62)))
    lengths = np.array([len(some) for some in words], np.int64)
    starts = 2 + np.arange(len(words)) + np.cumsum(lengths) - lengths
    text = np.zeros(1 + len(words) + len(flat), np.int64)
    inside = np.ones(len(text), bool)
    inside[0] = False
    inside[starts - 1] = False
    text[starts - 1] = 1 + np.arange(len(words))
    text[inside] = np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
    index = FMIndex(text, 1 + len(words) + len(numbers))
    index.drop_order()
    parents = index.parents(window)
    many = np.zeros(len(text), bool)  # by the word a window begins at
    asked = np.flatnonzero(once[held])
    starts, lengths = starts[asked], lengths[asked]
    low, high = np.zeros(len(asked), np.int64), np.full(len(asked), len(text), np.int64)
    matched = 0  # words that the rows of the segments still streamed match
    for step in range(int(lengths.max())):
        live = np.flatnonzero(lengths > step)
        at = starts[live] + lengths[live] - 1 - step
        below, above = index.step(text[at], low[live], high[live])
        matched += 1
        if matched > window:
            below, above = index.widen(parents, below, above)
            matched = window
        low[live], high[live] = below, above
        if matched == window:
            many[at] = above - below > 1
    for i, start, length in zip(held[asked].tolist(), starts.tolist(), lengths.tolist()):
        spans: list[tuple[int, int]] = []
        for p in np.flatnonzero(many[start : start + length]).tolist():
            if spans and p <= spans[-1][1]:
                spans[-1] = (spans[-1][0], p + window)
            else:
                spans.append((p, p + window))
        out[i] = spans
    return out


class Segments:
    """The segments of a block of texts that ``chosen`` takes by their anchors.

    ``owner`` is a segment's text and ``first`` its first word, counted through the block; ``anchors``,
    ``pieces`` (its words, parted by single spaces) and ``digests`` are per segment too.
    """

    def __init__(self, texts: list[bytes | None], window: int, gram: int, chosen: HashArray):
        self.words = words = Words(texts)
        first, last, keys = runs_of_anchors(words.hashes, words.first, window, gram)
        kept = np.flatnonzero(chosen.find(keys)[0] >= 0)
        first, last = first[kept], last[kept] + window - 1
        self.first, self.anchors = first, keys[kept].view(np.int64)
        odd = np.concatenate([[0], np.cumsum(
            (words.starts[1:] != words.ends[:-1] + 1) | (words.bytes[words.ends[:-1]] != 0x20))])
        self.pieces = [
            words.raw[a:b] if plain else b" ".join(words.raw[a:b].split())
            for a, b, plain in zip(words.starts[first].tolist(), words.ends[last].tolist(), (odd[first] == odd[last]).tolist())]
        self.digests = list(map(xxhash.xxh3_128_digest, self.pieces))


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests as two numbers each."""
    both = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1].view(np.int64)


def repeated_spans(
    docs: DataFrame, window: int, gram: int, shard_words: int, hot_segments: int,
) -> tuple[str, str, int]:
    """Folders of two arrays, and their number of ranges: the anchors that repeat, and of segments with
    repeated windows, by digest, the rest of the digest and the spans of words to remove (runs jobs)."""
    spark = docs.sparkSession
    n_ranges = max(16, shards_for(docs) // 4)  # a quarter: a block of texts asks for all of them
    folder, spans_folder = shared_files(spark, "anchors"), shared_files(spark, "spans")

    def anchors(texts):
        words = Words(texts)
        return runs_of_anchors(words.hashes, words.first, window, gram)[2]

    count_keys(docs, anchors, folder, n_ranges, least=2)

    def segments(frames):
        repeated, sent = HashArray(folder, n_ranges), set()
        for frame in (block for frame in frames for block in frame_blocks(frame)):
            found = Segments(frame["raw"].tolist(), window, gram, repeated)
            counts, at = Counter(found.digests), dict(zip(found.digests, range(len(found.digests))))
            own = list(at.values())
            if len(sent) > SENT:
                sent.clear()
            yield pd.DataFrame({
                "anchor": found.anchors[own], "digest": list(at), "n": [counts[d] for d in at],
                "words": [None if d in sent else found.pieces[i] for d, i in at.items()]})
            sent.update(at)
            found = None
        give_back()

    small_batches(spark)
    found = docs.select(F.col("text").cast("binary").alias("raw")).mapInPandas(
        segments, "anchor bigint, digest binary, n bigint, words binary")
    own = cut_lineage(found.groupBy("anchor", "digest").agg(
        F.first("words", ignorenulls=True).alias("words"), F.sum("n").alias("n")))
    hot = cut_lineage(own.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > hot_segments))

    def by_window(frames):
        for frame in frames:
            rows = []
            for digest, raw, n in zip(frame["digest"], frame["words"], frame["n"]):
                words = raw.split(b" ")
                for i in range(len(words) - window + 1):
                    piece = b" ".join(words[i : i + window])
                    rows.append((digest, i, xxhash.xxh3_128_digest(piece), piece, n))
            yield pd.DataFrame(rows, columns=["digest", "shift", "piece", "words", "n"])

    spread = cut_lineage(own.join(hot, "anchor", "left_semi").select("digest", "words", "n").mapInPandas(
        by_window, "digest binary, shift int, piece binary, words binary, n bigint"))
    pieces = own.join(hot, "anchor", "left_anti").select(
        F.col("anchor").alias("place"), F.col("digest").alias("piece"), "words", "n").union(
        spread.groupBy("piece").agg(F.first("words").alias("words"), F.sum("n").alias("n")).select(
            F.xxhash64("piece").alias("place"), "piece", "words", "n"))
    weight = own.agg(F.sum(F.length("words"))).first()[0] or 0
    n_shards = max(1, weight // (6 * shard_words))

    def search(frame):
        counts = frame["n"].to_numpy(np.int64)
        spans = segment_spans(frame["words"].tolist(), counts, frame["place"].to_numpy(np.int64), window)
        rows = [(p, a, b) for p, some in zip(frame["piece"], spans) for a, b in some]
        return pd.DataFrame(rows, columns=["piece", "first", "upto"])

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(n_shards)))
    matched = cut_lineage(dealt.groupBy("shard").applyInPandas(search, "piece binary, first int, upto int"))
    whole = matched.select(F.col("piece").alias("digest"), "first", "upto")
    shifted = spread.select("digest", "shift", "piece").join(matched, "piece").select(
        "digest", (F.col("shift") + F.col("first")).alias("first"), (F.col("shift") + F.col("upto")).alias("upto"))

    def store(frame):
        number = int(frame["range_no"].iloc[0])
        keys, rest = _halves(frame["digest"].tolist())
        order = np.argsort(keys)
        save(f"{spans_folder}/{number:06d}.keys.npy", keys[order])
        save(f"{spans_folder}/{number:06d}.counts.npy", np.column_stack([rest, frame["first"], frame["upto"]])[order])
        return pd.DataFrame({"n": [len(keys)]})

    head = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    range_no = F.shiftright(head, 33 - n_ranges.bit_length()).cast("int").alias("range_no")
    whole.union(shifted).select(range_no, "digest", "first", "upto").groupBy("range_no").applyInPandas(
        store, "n bigint").agg(F.sum("n")).collect()  # one row
    return folder, spans_folder, n_ranges


def without_repeats(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    window: int = 35,
    gram: int = 10,
    shard_words: int = 500_000,
    hot_segments: int = 4096,
) -> DataFrame:
    """Columns ``carry`` with ``n_words, n_removed, kept_sha256`` and ``kept`` (the words left)."""
    anchors, spans, n_ranges = repeated_spans(docs, window, gram, shard_words, hot_segments)

    def cut(batches):
        repeated, found = HashArray(anchors, n_ranges), HashArray(spans, n_ranges, (3,))
        for texts in batches:
            own = Segments(texts, window, gram, repeated)
            keys, rest = _halves(own.digests)
            at, rows = found.rows_of(keys)
            same = rows[:, 0] == rest[at]
            at, rows = at[same], rows[same]
            size = len(own.words.hashes) + 1
            opened = np.bincount(own.first[at] + rows[:, 1], minlength=size)
            opened -= np.bincount(own.first[at] + rows[:, 2], minlength=size)
            left = np.cumsum(opened)[:-1] == 0
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for raw, a, b in zip(texts, own.words.first[:-1].tolist(), own.words.first[1:].tolist()):
                kept = raw.split() if raw else []
                if not left[a:b].all():
                    kept = list(compress(kept, left[a:b].tolist()))
                joined = b" ".join(kept)
                out["n_words"].append(b - a)
                out["n_removed"].append(b - a - len(kept))
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                out["kept"].append(joined.decode("utf-8", "replace"))
            yield out

    rows = docs.select(F.struct(*dict.fromkeys(carry)).alias("row"), "text")
    return map_texts(rows, cut, "n_words bigint, n_removed bigint, kept_sha256 string, kept string",
                     ("row",)).select("row.*", "n_words", "n_removed", "kept_sha256", "kept")
