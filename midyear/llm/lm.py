"""An interpolated modified Kneser-Ney model, counted in Spark and read from mapped hash arrays.

Tokens are the words of a text, A-Z lowered, then one end; a text is preceded by begin marks that
are contexts only.  The vocabulary is a sorted array of word hashes; a word's number is its
place there, but the most frequent words have the smallest numbers, which pack best.  n-grams go to
ranges by their context, those of very frequent contexts by their last word too, so that no range
holds more than its share.  A range adds up its n-grams, writes their keys in order with their
counts, and hands on to the next lower order the totals of its contexts, which are n-grams there,
and how many contexts precede each shorter n-gram.  A block of texts looks each of its distinct
n-grams up once.

p(w | context) = max(c - D(c), 0) / total + left * p(w | shorter context), down to the uniform
1 / (V + 1); D(1), D(2), D(3 and more) come from the counts of counts of each order.  Null texts
are empty texts: their only token is the end.  Repeated rows count each.  Without training
rows every probability is 1.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from midyear.llm.hasharrays import (
    GATHERED, HashArray, count_keys, in_32_bits, numbered, range_of, remove, save, save_counts,
    shards_for, shared_files, shuffles_go, small_argsort,
)
from midyear.llm.texts import Words, frame_blocks, give_back, map_texts, mix
from midyear.sources.shared import fresh_path

END = np.uint64(xxhash.xxh64_intdigest(b" "))  # a space is in no word
#: Most frequent words that have the smallest numbers.
SMALL = 1 << 13
#: Parts of the ranges that an order hands to the next lower one in turn.
PARTS = 4


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, and where each text's begin."""
    words = Words(texts, lower=True)
    return np.insert(words.hashes, words.first[1:], END), words.first + np.arange(len(words.first))


def padded(numbers: np.ndarray, starts: np.ndarray, order: int, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers with begin marks before each text's first, and where the tokens are among them."""
    texts = np.repeat(np.arange(1, len(starts)), np.diff(starts))
    return np.insert(numbers, np.repeat(starts[:-1], order - 1), begin), np.arange(len(numbers)) + texts * (order - 1)


def _pieces(seq: np.ndarray, at: np.ndarray, table: np.ndarray, order: int):
    """Parts whose n-grams fit in 64 bits: ``seq`` (places in ``table``), where n-grams end, ``table``, bits a place."""
    bits = max(1, (len(table) - 1).bit_length())
    if order * bits <= 64:
        yield seq, at, table, bits
        return
    for part in np.array_split(at, 2):
        low = part[0] - order + 1
        used, back = numbered(seq[low : part[-1] + 1])
        yield from _pieces(back, part - low, table[used], order)


def _side_by_side(seq: np.ndarray, at: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The n-grams that end ``at``, each as one number."""
    seq, out = seq.astype(np.uint64), np.zeros(len(at), np.uint64)
    for back in range(order - 1, -1, -1):
        out = (out << np.uint64(bits)) | seq[at - back]
    return out


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ordered array, with how often each stands."""
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[first], np.diff(np.append(first, len(ordered)))


def key_of(rows: np.ndarray) -> np.ndarray:
    """A key for each line: its numbers side by side for two, hashed on beyond."""
    key = rows[:, 0].astype(np.uint64)
    for k in range(1, rows.shape[1]):
        key = (key << np.uint64(32)) | rows[:, 1].astype(np.uint64) if k == 1 else mix(key, rows[:, k].astype(np.uint64))
    return key


def _scatter(key: np.ndarray) -> np.ndarray:
    return mix(key, np.uint64(0x632BE59BD9B4E019))


class Ranges:
    """Which range an n-gram belongs to: its context's, spread by the last word after frequent ones."""

    def __init__(self, n: int, frequent: np.ndarray):
        self.n, self.frequent = n, frequent

    def of(self, rows: np.ndarray) -> np.ndarray:
        if rows.shape[1] == 1:
            return range_of(_scatter(key_of(rows)), self.n)
        return self.after(key_of(rows[:, :-1]), np.isin(rows[:, -2], self.frequent), rows[:, -1])

    def after(self, context: np.ndarray, frequent: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The same from the keys of contexts, whether their last words are frequent, and the words that follow."""
        spread, hot = _scatter(context), np.flatnonzero(frequent)
        spread[hot] = mix(spread[hot], last[hot].astype(np.uint64))
        return range_of(spread, self.n)


def _distinct(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, their lines and summed counts."""
    key = key_of(rows)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    summed = np.add.reduceat(counts[order], first) if len(key) else counts
    return key[first], rows[order[first]], summed


def _blocks(kind: int, where: np.ndarray, *arrays: np.ndarray) -> list[tuple]:
    """One row per range with its lines of ``arrays``, packed, in the order they have; counts last."""
    order = small_argsort(where, int(where.max(initial=0)) + 1)
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(where[order]) != 0])) if len(where) else []
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(where)]):
        at = order[a:b]
        out.append((kind, int(where[at[0]]), *[_packed(array[at]) for array in arrays]))
    return out


def _packed(array: np.ndarray) -> bytes:
    """Column by column, and of each the lowest bytes first, then the next: in order, they pack small."""
    lines = array.reshape(len(array), -1)
    planes = np.ascontiguousarray(lines.T).view(np.uint8).reshape(lines.shape[1], len(array), -1).transpose(0, 2, 1)
    return zstandard.compress(planes.tobytes())


def _unpacked(packed: pd.Series, kind: type, width: int = 1) -> np.ndarray:
    """The lines of all blocks, one below the other."""
    size = np.dtype(kind).itemsize
    if not len(packed):
        return np.zeros((0, width) if width > 1 else 0, kind)
    parts = [np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(width, size, -1).transpose(2, 0, 1)).view(kind)[:, :, 0]
             for b in packed]
    return np.concatenate(parts) if width > 1 else np.concatenate(parts)[:, 0]


SENT = "kind int, range_no int, lines binary, counts binary"
NAMES = ["kind", "range_no", "lines", "counts"]


class KneserNey:
    """A fitted model: folders and totals; its arrays are opened in tasks."""

    def __init__(self, folder: str, n_ranges: int, order: int, vocabulary: pd.DataFrame):
        self.folder, self.order = folder, order
        self.size = int(vocabulary["n_keys"].sum())
        self.total = int(vocabulary["total"].sum())
        self.discounts: dict[int, np.ndarray] = {}
        self.empty: np.ndarray | None = None  # totals of the empty context
        start = np.concatenate([[0], np.cumsum(vocabulary["n_keys"])]).astype(np.int64)
        places = np.array([s + p for s, some in zip(start, vocabulary["top"]) for p in some], np.int64)
        counts = np.array([c for some in vocabulary["top_counts"] for c in some], np.int64)
        by_count = np.argsort(-counts, kind="stable")
        small = places[by_count[:SMALL]]
        # frequent words take the smallest numbers, the words with those places the frequent words' places
        aside = np.setdiff1d(np.arange(len(small)), small)
        moved = np.concatenate([small, aside])
        to = np.concatenate([np.arange(len(small)), np.sort(small[small >= len(small)])])
        line = np.argsort(moved)
        self.moved, self.to = moved[line], to[line]
        self.ranges = Ranges(n_ranges, self._number(places[counts > self.total / (4 * n_ranges)]).astype(np.uint64))
        in_32_bits(np.array([self.size + 1]))  # the largest number

    def open(self) -> "KneserNey":
        self.words = HashArray(f"{self.folder}/words", self.ranges.n)
        # n-grams below the highest order have their totals as a context beside their count
        self.grams = {k: HashArray(f"{self.folder}/grams{k}", self.ranges.n, () if k == self.order else (5,), bytes=True)
                      for k in range(1, self.order + 1)}
        return self

    def _number(self, places: np.ndarray) -> np.ndarray:
        if not len(self.moved):
            return places
        at = np.minimum(np.searchsorted(self.moved, places), len(self.moved) - 1)
        return np.where(self.moved[at] == places, self.to[at], places)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number and the count of each word; a word never seen has the number after the begin mark's."""
        place, count = self.words.find(hashes)
        return np.where(place < 0, self.size + 1, self._number(place)), count

    def read(self, texts: list[bytes | None]) -> tuple[np.ndarray, ...]:
        """The padded texts as places in a table of numbers, their tokens, the table, where texts start, counts."""
        hashes, starts = tokens(texts)
        distinct, back = numbered(hashes)
        number, count = self.numbers(distinct)
        table, place = numbered(np.append(number, self.size))
        seq, at = padded(place[back], starts, self.order, place[-1])
        return seq, at, table, starts, count[back]

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Of each line's last number after the others."""
        table, back = numbered(rows.ravel())
        return self.probabilities_at(back, np.arange(self.order - 1, rows.size, self.order), table)

    def probabilities_at(self, seq: np.ndarray, at: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Of the numbers ``at`` after those before them; ``seq`` has places in ``table``."""
        if not self.total or not len(at):
            return np.full(len(at), 1.0 / (self.size + 1))
        return np.concatenate([self._piece(*piece) for piece in _pieces(seq, at, table, self.order)])

    def _piece(self, seq: np.ndarray, at: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
        grams, back = numbered(_side_by_side(seq, at, self.order, bits))
        asked, context, shorter = {self.order: grams}, {}, {}
        for k in range(self.order, 1, -1):
            before = asked[k] >> np.uint64(bits)
            after = asked[k] & np.uint64((1 << bits * (k - 1)) - 1)
            asked[k - 1] = _runs(np.sort(np.concatenate([before, after])))[0]
            context[k], shorter[k] = np.searchsorted(asked[k - 1], before), np.searchsorted(asked[k - 1], after)
        numbers = table.astype(np.uint64)
        often = np.isin(numbers, self.ranges.frequent)
        p = 1.0 / (self.size + 1)
        for k in range(1, self.order + 1):
            last = (asked[k] & np.uint64((1 << bits) - 1)).astype(np.int64)
            if k == 1:
                key = numbers[last]
                where, stats = range_of(_scatter(key), self.ranges.n), self.empty[None, :]
            else:
                above, stats, p = key[context[k]], found[context[k], 1:], p[shorter[k]]
                where = self.ranges.after(above, hot[context[k]], numbers[last])
                key = (above << np.uint64(32)) | numbers[last] if k == 2 else mix(above, numbers[last])
            found, hot = self.grams[k].find(key, where)[1], often[last]
            count, d = found if k == self.order else found[:, 0], self.discounts[k]
            known = stats[:, 0] > 0
            total = np.where(known, stats[:, 0], 1)
            seen = np.maximum(count - d[np.minimum(count, 3)], 0.0) / total
            left = np.where(known, stats[:, 1:] @ d[1:] / total, 1.0)
            p = seen + left * p
        return p[back]


def _discounts(n: np.ndarray) -> np.ndarray:
    """D(0..3) from the numbers of n-grams seen 1, 2, 3 and 4 times; halves where those are too few."""
    n1, n2, n3, n4 = (int(x) for x in n)
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(found, 0.0, [0.0, 1.0, 2.0, 3.0])


def fit(docs: DataFrame, order: int = 3) -> KneserNey:
    """Count the model over all texts of ``docs`` (runs its jobs)."""
    spark, n = docs.sparkSession, shards_for(docs) << max(0, order - 2)  # longer lines, more ranges
    folder = shared_files(spark, "kneser-ney")
    for name in ["words", *[f"grams{k}" for k in range(1, order + 1)]]:
        shared_sub(folder, name)
    with shuffles_go(spark):
        vocabulary = count_keys(docs, lambda texts: tokens(texts)[0], f"{folder}/words", n)
        model = KneserNey(folder, n, order, vocabulary)
        sent = docs.select(F.col("text").cast("binary").alias("raw")).mapInPandas(_counter(model), SENT)
        held = fresh_path(spark, "kneser-ney-level")
        _write(sent.groupBy("range_no").applyInPandas(_level(model, order), SENT), held, 0)
        _totals(model, order, _held(spark, held))
        for k in range(order - 1, 0, -1):
            above, held = held, fresh_path(spark, "kneser-ney-level")
            for part in range(PARTS):  # one after the other, so that no more than a part is both held and shuffled
                sent = _held(spark, above).filter(F.col("part") == part).select(NAMES)
                _write(sent.groupBy("range_no").applyInPandas(_level(model, k), SENT), held, part)
                for job in range(PARTS):  # what they became is written: nothing reads these rows any more
                    remove(spark, f"{above}/job={job}/part={part}")
            remove(spark, above)
            _totals(model, k, _held(spark, held))
        remove(spark, held)
    return model


def _write(df: DataFrame, folder: str, job: int) -> None:
    """Write ``df`` once to the shared folder, packed small, the totals and each part of the ranges apart (runs a job)."""
    part = F.when(F.col("kind") == 0, -1).otherwise(F.col("range_no") % PARTS)
    df.withColumn("part", part).write.option("compression", "zstd").partitionBy("part").parquet(f"{folder}/job={job}")


def _held(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{SENT}, job int, part int").parquet(folder)


def _totals(model: KneserNey, k: int, held: DataFrame) -> None:
    """Add up what the ranges of order ``k`` say of themselves."""
    totals = np.zeros(9, np.int64)
    for row in held.filter("part = -1").collect():  # one row a range
        totals += np.frombuffer(row["counts"], np.int64)
    model.discounts[k] = _discounts(totals[:4])
    if k == 1:
        model.empty = totals[4:8]


def shared_sub(folder: str, name: str) -> None:
    import os

    os.makedirs(f"{folder}/{name}", exist_ok=True)


def _counter(model: KneserNey):
    def run(frames):
        model.open()
        held, size = [], 0

        def send():
            # the blocks as one: their places in one table
            sizes = np.cumsum([0, *[len(seq) for seq, _, _ in held]])
            table, place = numbered(np.concatenate([t for _, _, t in held]))
            before = np.cumsum([0, *[len(t) for _, _, t in held]])
            seq = np.concatenate([place[b + s] for b, (s, _, _) in zip(before, held)])
            at = np.concatenate([b + a for b, (_, a, _) in zip(sizes, held)])
            held.clear()
            out = []
            for seq, at, table, bits in _pieces(seq, at, table, model.order):
                grams, counts = _runs(np.sort(_side_by_side(seq, at, model.order, bits)))
                rows = np.empty((len(grams), model.order), np.uint32)
                for back in range(model.order):
                    rows[:, -1 - back] = table[((grams >> np.uint64(back * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)]
                out += _blocks(2, model.ranges.of(rows), rows, in_32_bits(counts))
            return pd.DataFrame(out, columns=NAMES)

        for frame in (block for frame in frames for block in frame_blocks(frame)):
            held.append(model.read(frame["raw"].tolist())[:3])
            size += len(held[-1][1])
            if size > GATHERED:
                yield send()
                size = 0
                give_back()
        if held:
            yield send()
        give_back()

    return run


def _level(model: KneserNey, k: int):
    """Add a range's k-grams up, write them with the totals that the order above found for them as contexts."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        give_back()
        number = int(frame["range_no"].iloc[0])
        grams, above = frame[frame["kind"] == 2], frame[frame["kind"] == 1]
        rows = _unpacked(grams["lines"], np.uint32, k).reshape(-1, k)
        counts = _unpacked(grams["counts"], np.uint32).astype(np.int64)
        sums = _unpacked(above["lines"], np.uint64), _unpacked(above["counts"], np.uint32, 4).astype(np.int64)
        frame = grams = above = None
        key, rows, counts = _distinct(rows, counts)
        keys, held = (key, counts) if k == model.order else _beside(key, counts, *add_up_rows(*sums))
        save(f"{model.folder}/grams{k}/{number:06d}.keys.npy", keys)
        save_counts(f"{model.folder}/grams{k}/{number:06d}.counts.npy", held)
        keys = held = sums = None
        often = [int((counts == c).sum()) for c in (1, 2, 3, 4)]
        least = [int(counts.sum()), often[0], often[1], int((counts > 2).sum()), len(key)]
        out = [(0, number, b"", np.array(often + least, np.int64).tobytes())]
        if k > 1:
            context, line, stats = _context_totals(key_of(rows[:, :-1]), counts)
            out += _blocks(1, model.ranges.of(rows[line, :-1]), context, in_32_bits(stats))
            context = line = stats = None
            shorter, before = _shorter(rows[:, 1:])
            out += _blocks(2, model.ranges.of(shorter), shorter, in_32_bits(before))
        return pd.DataFrame(out, columns=NAMES)

    return merge


def _shorter(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct lines, and how often each stands."""
    if rows.shape[1] > 2:
        return _distinct(rows, np.ones(len(rows), np.int64))[1:]
    key, counts = _runs(np.sort(key_of(rows)))
    parts = [key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)]
    return np.stack(parts[2 - rows.shape[1]:], axis=1).astype(np.uint32), counts


def _context_totals(context: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each context: a line that has it, the summed counts, and how many n-grams were seen once, twice, more often."""
    if not len(context):
        return context, np.zeros(0, np.int64), np.zeros((0, 4), np.int64)
    order = np.argsort(context)
    context, counts = context[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    columns = (counts, counts == 1, counts == 2, counts > 2)
    return context[first], order[first], np.stack([np.add.reduceat(c, first, dtype=np.int64) for c in columns], axis=1)


def add_up_rows(keys: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, stats
    order = np.argsort(keys)
    keys, stats = keys[order], stats[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(stats, first, axis=0)


def _beside(key: np.ndarray, counts: np.ndarray, context: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order with their counts and their totals as contexts; only begin marks are contexts and no n-gram."""
    keys = _runs(np.sort(np.concatenate([key, context])))[0]
    out = np.zeros((len(keys), 5), np.int64)
    out[np.searchsorted(keys, key), 0] = counts
    out[np.searchsorted(keys, context), 1:] = stats
    return keys, out


def score(docs: DataFrame, model: KneserNey, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` with ``n_tokens, n_known, base_score, score, perplexity``."""

    def work(batches):
        model.open()
        for texts in batches:
            if not len(texts):
                yield {name: [] for name in ("n_tokens", "n_known", "base_score", "score")}
                continue
            seq, at, table, starts, count = model.read(texts)
            base = np.log10((count + 1) / (model.total + model.size + 1))
            logs = np.log10(model.probabilities_at(seq, at, table))
            yield {
                "n_tokens": np.diff(starts),
                "n_known": np.add.reduceat((count > 0).astype(np.int64), starts[:-1]),
                "base_score": np.add.reduceat(base, starts[:-1]),
                "score": np.add.reduceat(logs, starts[:-1]),
            }

    scored = map_texts(docs, work, "n_tokens bigint, n_known bigint, base_score double, score double", carry)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
