"""Near-duplicate lines removed by an exact set-similarity join with prefix filters.

A line is the set of its words, A-Z lowered; lines without words are no lines and stay.  A line is
removed if an earlier one has a Jaccard similarity of ``share`` or more; earlier is by document
id (null last), then by a hash of the text, then by place.  The words of a set stand in order of
rarity in the corpus, read from a sorted hash array.  Lines with equal sets are joined first: a block of
texts sends each set once, with its earliest line there; the earliest of all is stored, and the last
pass over the documents removes the others.  For each remaining set:

* prefix filter: two similar sets share at least one word in the first ``n - ceil(share n) + 1``
  of each, and at least two in one word more.  Rare words are keys by themselves; frequent words
  are keys together with a later word of the longer prefix, or, in long sets, by themselves;
* sets that meet at a key are compared if their sizes, the places of the shared word and a parity
  signature of 128 bits (two sets differ in at least as many words as in bits) allow it;
* the Jaccard similarity of the rest is verified on their words, which are mapped from the shared
  folder.  A set for which an earlier match is found is compared no further.

So nothing is output for pairs, and what travels is a key and a number of the set.  Null texts
have no lines.  Rows with equal id and text are one document: their lines do not remove each other.
"""

from __future__ import annotations

import hashlib
import os
import shutil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from midyear.llm.hasharrays import (
    HashArray, Mapped, count_keys, in_32_bits, numbered, range_of, save, shards_for, shared_files, small_argsort,
)
from midyear.llm.texts import Words, frame_blocks, give_back, map_texts, mix
from midyear.sources.shared import cut_lineage

LAST = np.int64(2**63 - 1)  # stands for a null id
SENT = "range_no int, docs binary, texts binary, lines binary, first binary, second binary, sizes binary, words binary"
NAMES = ["range_no", "docs", "texts", "lines", "first", "second", "sizes", "words"]
HEAD = ("docs", "texts", "lines")
#: One row a set: where its words begin and its signature; its second hash and earliest line; a removed line.
SET = np.dtype([("begin", np.uint32), ("low", np.uint64), ("high", np.uint64)])
LINE = np.dtype([("second", np.uint64), ("docs", np.int64), ("texts", np.uint64), ("lines", np.int32)])
GONE = np.dtype([("text_hash", np.int64), ("line", np.int32)])
#: Words that a task copies from the mapped files at most, to verify pairs on.
COPIED = 16_000_000


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the ranges ``starts`` .. ``starts + sizes``, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _rows(kind: np.dtype, **columns: np.ndarray) -> np.ndarray:
    """Columns side by side, so that a row is one place in a file."""
    out = np.empty(len(next(iter(columns.values()))), kind)
    for name, column in columns.items():
        out[name] = column
    return out


def _runs(sorted_numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """Each number with the range in which it stands."""
    cuts = np.flatnonzero(np.concatenate([[True], sorted_numbers[1:] != sorted_numbers[:-1]])) if len(sorted_numbers) else []
    return [(int(sorted_numbers[a]), int(a), int(b)) for a, b in zip(cuts, [*cuts[1:], len(sorted_numbers)])]


class Join:
    """Settings and folders of one run, sent to the tasks."""

    def __init__(self, folder: str, n_ranges: int, share: tuple[int, int], frequent: int, long: int):
        self.folder, self.n = folder, n_ranges
        self.num, self.den = share
        self.frequent, self.long = frequent, long

    def prefix(self, sizes: np.ndarray) -> np.ndarray:
        return sizes + (-sizes * self.num // self.den) + 1

    def alone(self, sizes: np.ndarray) -> np.ndarray:
        """Sizes at which only equal sets are similar enough."""
        return (-(-sizes * self.num // self.den) == sizes) & (sizes * self.den // self.num == sizes)

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that sets of these sizes must share."""
        return -(-(a + b) * self.num // (self.num + self.den))


def _line_sets(sizes: np.ndarray, number_of: np.ndarray, rarity: np.ndarray):
    """Distinct words of each line (of ``sizes`` words) in the order ``rarity``, how many, and where they begin."""
    rank = np.empty(len(rarity), np.int64)
    rank[rarity] = np.arange(len(rarity))
    key = np.sort(np.repeat(np.arange(len(sizes)) << 32, sizes) | rank[number_of])
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    size = np.bincount(key >> 32, minlength=len(sizes))
    return rarity[key & 0xFFFFFFFF], size, np.cumsum(size) - size


def _set_hashes(head: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the set of words of each line, from the upper 40 bits of the words' hashes."""
    owner = np.repeat(np.arange(len(head), dtype=np.uint64), np.diff(np.append(head, len(hashes))))
    word, low = hashes >> np.uint64(24), np.uint64(40)
    if len(head) < 1 << 24:
        key = owner << low | word
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        owner, word = key >> low, key & np.uint64((1 << 40) - 1)
    else:
        order = np.lexsort((word, owner))
        owner, word = owner[order], word[order]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])])
        owner, word = owner[new], word[new]
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return np.add.reduceat(mix(word, np.uint64(1)), begin), np.add.reduceat(mix(word, np.uint64(2)), begin)


def _text_hashes(texts: list[bytes | None]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(raw or b"") for raw in texts], np.uint64)


def _sets(join: Join):
    """Packed sets by their range, each once a block: id, text and place of its earliest line, set hash, and words."""

    def run(frames):
        counts = HashArray(f"{join.folder}/words", join.n)
        for frame in (block for frame in frames for block in frame_blocks(frame)):
            texts = frame["raw"].tolist()
            words = Words(texts, lower=True)
            owner, place, head = words.lines()
            if not len(head):
                continue
            first, second = _set_hashes(head, words.hashes)
            ids = np.where(frame["id"].isna(), LAST, frame["id"].fillna(0)).astype(np.int64)
            hashed = _text_hashes(texts)
            docs, text_hash = ids[owner], hashed[owner]
            # copies of a line in the order of their documents: one number a text, then the place
            texts_by = np.lexsort((hashed, ids))
            turn = np.empty(len(ids), np.int64)
            turn[texts_by] = np.arange(len(ids))
            by = np.lexsort((turn[owner] << 32 | place, second, first))
            new = (first[by][1:] != first[by][:-1]) | (second[by][1:] != second[by][:-1])
            shown = by[np.concatenate([[True], new])]
            where = range_of(mix(first[shown], second[shown]), join.n)
            order = small_argsort(where, join.n)
            shown, where = shown[order], where[order]
            # only the words of the lines that go on are looked up and put in order
            lengths = np.diff(np.append(head, len(words.hashes)))[shown]
            hashes, number_of = numbered(words.hashes[_ragged(head[shown], lengths)])
            number, count = counts.find(hashes)  # numbers ascend as the hashes do
            word, size, begin = _line_sets(lengths, number_of, np.argsort(count, kind="stable"))
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(where) != 0]))
            rows = []
            for a, b in zip(cuts, [*cuts[1:], len(shown)]):
                at = shown[a:b]
                numbers = in_32_bits(number[word[begin[a] : begin[b - 1] + size[b - 1]]])
                rows.append((int(where[a]), docs[at].tobytes(), text_hash[at].tobytes(),
                             place[at].astype(np.int32).tobytes(), first[at].tobytes(), second[at].tobytes(),
                             size[a:b].astype(np.int32).tobytes(), _planes(numbers)))
            yield pd.DataFrame(rows, columns=NAMES)
        give_back()

    return run


def _planes(numbers: np.ndarray) -> bytes:
    """Lowest bytes first, then the next: the upper bytes are alike and shrink on their way."""
    return numbers.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1)


def _store(join: Join):
    """Write the distinct sets of a range with their earliest lines; out go the keys of the sets."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        give_back()
        number = int(frame["range_no"].iloc[0])
        read = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in frame[name]])
        docs, texts, lines = read("docs", np.int64), read("texts", np.uint64), read("lines", np.int32)
        first, second = read("first", np.uint64), read("second", np.uint64)
        sent = read("sizes", np.int32).astype(np.int64)
        words = np.concatenate([_from_planes(b) for b in frame["words"]])
        begin = np.cumsum(sent) - sent
        order = np.lexsort((lines, texts, docs, second, first))
        new = np.concatenate([[True], (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])])
        heads = order[new]
        sizes = sent[heads]
        words = words[_ragged(begin[heads], sizes)].astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        low, high = signatures(words, begin)
        path = f"{join.folder}/sets/{number:06d}"
        none = np.zeros(1, np.uint64)  # the row after the last says where its words end
        save(f"{path}.rows.npy", _rows(SET, begin=in_32_bits(np.append(begin, len(words))), low=np.append(low, none), high=np.append(high, none)))
        save(f"{path}.words.npy", words.astype(np.uint32))
        path = f"{join.folder}/heads/{number:06d}"
        save(f"{path}.first.npy", first[heads])
        save(f"{path}.rows.npy", _rows(LINE, second=second[heads], docs=docs[heads], texts=texts[heads], lines=lines[heads]))
        keys, sets, places = _keys(join, words, begin, sizes)
        where = range_of(keys, join.n)
        sorted_by = np.argsort(where, kind="stable")
        cuts = np.searchsorted(where[sorted_by], np.arange(join.n + 1))
        out = []
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]):
            at = sorted_by[cuts[k] : cuts[k + 1]]
            out.append((int(k), number, keys[at].tobytes(), sets[at].astype(np.uint32).tobytes(),
                        places[at].astype(np.uint32).tobytes()))
        return pd.DataFrame(out, columns=["bucket", "range_no", "keys", "sets", "places"])

    return merge


def signatures(words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 parity bits of each set: a word flips one bit."""
    spot = mix(words.astype(np.uint64), np.uint64(3))
    bit = np.uint64(1) << (spot & np.uint64(63))
    upper = (spot >> np.uint64(6)) & np.uint64(1) == 1
    zero = np.uint64(0)
    return (np.bitwise_xor.reduceat(np.where(upper, zero, bit), begin),
            np.bitwise_xor.reduceat(np.where(upper, bit, zero), begin))


def _keys(join: Join, words: np.ndarray, begin: np.ndarray, sizes: np.ndarray):
    """Keys of all sets, the sets' numbers, and the places of the (first) word of each key."""
    counts = HashArray(f"{join.folder}/words", join.n)
    prefix = np.where(join.alone(sizes), 0, join.prefix(sizes))
    owner = np.repeat(np.arange(len(sizes)), prefix)
    at = _ragged(begin, prefix)
    place = at - begin[owner]
    count = counts.counts_at(words[at])
    out = []

    def add(some, key):
        out.append((key, owner[some], place[some]))

    used = count > 1  # a word seen once joins nothing
    word = words[at].astype(np.uint64)
    light = np.flatnonzero(used & (count <= join.frequent))
    add(light, mix(word[light], np.uint64(11)))
    heavy = used & (count > join.frequent)
    lone = np.flatnonzero(heavy & (5 * sizes[owner] >= 4 * join.long))
    add(lone, mix(word[lone], np.uint64(12)))
    paired = np.flatnonzero(heavy & (sizes[owner] < join.long))
    more = prefix[owner[paired]] - place[paired]  # later words in a prefix one longer
    more = np.minimum(more, sizes[owner[paired]] - 1 - place[paired])
    twice = np.repeat(paired, more)
    later = words[_ragged(at[paired] + 1, more)].astype(np.uint64)
    add(twice, mix(mix(word[twice], np.uint64(13)), later))
    return tuple(np.concatenate(parts) for parts in zip(*out))


class SetStore:
    """Some of the stored sets: the sets ``at`` in the ranges ``part`` (in order), read in a task."""

    def __init__(self, join: Join, part: np.ndarray, at: np.ndarray):
        self.folder, self.files, self.part = join.folder, Mapped(), part
        found = {name: [] for name in (*HEAD, "low", "high", "begin", "sizes")}
        for k, a, b in _runs(part):
            some = at[a:b]
            line, row = self._file("heads", k, "rows")[some], self._file("sets", k, "rows")
            here, after = row[some], row["begin"][some + 1]
            for name in found:
                found[name].append(line[name] if name in HEAD else after - here["begin"] if name == "sizes" else here[name])
        self.columns = {name: np.concatenate(arrays) for name, arrays in found.items()}
        self.begin, self.sizes = (self.columns[name].astype(np.int64) for name in ("begin", "sizes"))
        self.copied = None  # the words of the sets one after another, unless they are too many
        if self.sizes.sum() <= COPIED:
            self.copied = np.concatenate([self._file("sets", k, "words")[_ragged(self.begin[a:b], self.sizes[a:b])]
                                          for k, a, b in _runs(part)])
            self.spot = np.cumsum(self.sizes) - self.sizes

    def _file(self, folder: str, k: int, name: str) -> np.ndarray:
        return self.files.get(f"{self.folder}/{folder}/{k:06d}.{name}.npy")

    def words(self, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of some of the sets, and for each word which of ``sets`` it is from."""
        if self.copied is not None:
            sizes = self.sizes[sets]
            return self.copied[_ragged(self.spot[sets], sizes)], np.repeat(np.arange(len(sets)), sizes)
        words, owner = [], []
        order = np.argsort(self.part[sets], kind="stable")
        for k, a, b in _runs(self.part[sets[order]]):
            some = order[a:b]
            size = self.sizes[sets[some]]
            words.append(self._file("sets", k, "words")[_ragged(self.begin[sets[some]], size)])
            owner.append(np.repeat(some, size))
        return np.concatenate(words), np.concatenate(owner)


FOUND = "doc bigint, text_hash bigint, line int"


def _matches(join: Join):
    """The lines of a bucket's sets that an earlier set matches."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        give_back()
        read = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in frame[name]])
        keys, places = read("keys", np.uint64), read("places", np.uint32).astype(np.int32)
        ranges = np.repeat(frame["range_no"].to_numpy(np.int64), [len(b) // 8 for b in frame["keys"]])
        names, local = numbered(ranges << 32 | read("sets", np.uint32))
        store = SetStore(join, names >> 32, names & 0xFFFFFFFF)
        at = store.columns
        order = np.lexsort((at["lines"], at["texts"], at["docs"]))
        turn = np.empty(len(names), np.int64)
        turn[order] = np.arange(len(names))
        by = np.argsort(numbered(keys)[1] << 32 | turn[local])
        keys, local, places = keys[by], local[by].astype(np.int32), places[by]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank = (np.arange(len(keys)) - np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))).astype(np.int32)
        sizes = store.sizes[local]
        low, high = at["low"][local], at["high"][local]
        # a similar set has at most this many other words, whatever its size
        other = np.minimum(sizes * (join.den - join.num) // join.num, 255).astype(np.uint8)
        done = np.zeros(len(names), bool)
        live, back, fresh = np.flatnonzero(rank > 0), 0, False
        while len(live):
            back += 1  # compare each with the set ``back`` places before it at the same key
            live = live[rank[live] >= back]
            if fresh:
                live = live[~done[local[live]]]
                fresh = False
            near = live[np.bitwise_count(low[live] ^ low[live - back]) <= other[live]]
            x, y = near, near - back
            nx, ny, px, py = sizes[x], sizes[y], places[x], places[y]
            need = join.overlap(nx, ny)
            apart = (np.bitwise_count(low[x] ^ low[y]).astype(np.int64) + np.bitwise_count(high[x] ^ high[y]))
            may = ((nx * join.den >= ny * join.num) & (ny * join.den >= nx * join.num)
                   & (np.minimum(px, py) + np.minimum(nx - px, ny - py) >= need)
                   & (apart <= nx + ny - 2 * need) & (local[x] != local[y]))
            tried = np.flatnonzero(may)
            for first in range(0, len(tried), 20_000):
                some = tried[first : first + 20_000]
                a, b = local[x[some]], local[y[some]]
                both = np.concatenate([owner << 32 | words for words, owner in (store.words(a), store.words(b))])
                both.sort()
                shared = np.bincount(both[1:][both[1:] == both[:-1]] >> 32, minlength=len(some))
                done[a[shared >= need[some]]] = fresh = True
        return pd.DataFrame({"doc": at["docs"][done], "text_hash": at["texts"][done].view(np.int64),
                             "line": at["lines"][done]})

    return run


class Heads:
    """The earliest line of each set, opened in a task."""

    def __init__(self, join: Join):
        self.folder, self.n, self.files = f"{join.folder}/heads", join.n, Mapped()

    def copies(self, texts: list[bytes | None], ids: list[int | None], hashes: np.ndarray) -> tuple[dict[int, list[int]], list[int]]:
        """By text, the places of its lines whose set has an earlier line; and how many lines each text has."""
        words = Words(texts, lower=True)
        owner, place, head = words.lines()
        if not len(head):
            return {}, [0] * len(texts)
        first, second = _set_hashes(head, words.hashes)
        docs = np.array([int(LAST) if i is None else i for i in ids], np.int64)[owner]
        own = (docs, hashes[owner], place)
        where = range_of(mix(first, second), self.n)
        order = np.argsort(first)
        order = order[small_argsort(where[order], self.n)]  # asked in the order of the files
        late = np.zeros(len(head), bool)
        for k, a, b in _runs(where[order]):
            some = order[a:b]
            firsts, rows = [self.files.get(f"{self.folder}/{k:06d}.{name}.npy") for name in ("first", "rows")]
            at = np.searchsorted(firsts, first[some])
            kept = rows[at]
            while (other := np.flatnonzero(kept["second"] != second[some])).size:  # sets with the same first hash
                at[other] += 1
                kept[other] = rows[at[other]]
            late[some] = np.any([mine[some] != kept[name] for mine, name in zip(own, HEAD)], axis=0)
        gone: dict[int, list[int]] = {}
        for i, line in zip(owner[late].tolist(), place[late].tolist()):
            gone.setdefault(i, []).append(line)
        return gone, np.bincount(owner, minlength=len(texts)).tolist()


def matched_lines(docs: DataFrame, share: tuple[int, int], frequent: int, long: int) -> tuple[Join, DataFrame]:
    """``doc, text_hash, line`` (once or more) of the earliest lines of sets that an earlier set matches.

    The folder of the join has the earliest line of each set then.
    """
    spark, n = docs.sparkSession, shards_for(docs)
    folder = shared_files(spark, "lines")
    for name in ("words", "sets", "heads", "removed"):
        os.makedirs(f"{folder}/{name}", exist_ok=True)
    join = Join(folder, n, share, frequent, long)
    count_keys(docs, lambda texts: Words(texts, lower=True).hashes, f"{folder}/words", n)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("raw"))
    keys = rows.mapInPandas(_sets(join), SENT).groupBy("range_no").applyInPandas(
        _store(join), "bucket int, range_no int, keys binary, sets binary, places binary")
    return join, cut_lineage(keys.groupBy("bucket").applyInPandas(_matches(join), FOUND))


def _write_removed(join: Join):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["range_no"].iloc[0])
        frame = frame.drop_duplicates().sort_values(["doc", "text_hash", "line"])
        save(f"{join.folder}/removed/{number:06d}.doc.npy", frame["doc"].to_numpy())
        save(f"{join.folder}/removed/{number:06d}.rows.npy", _rows(GONE, **{name: frame[name].to_numpy() for name in GONE.names}))
        return pd.DataFrame({"range_no": [number]})

    return run


def _doc_range(docs: np.ndarray, n: int) -> np.ndarray:
    return range_of(mix(docs.view(np.uint64), np.uint64(5)), n)


class Removed:
    """The lines that an earlier set matches, opened in a task."""

    def __init__(self, join: Join):
        self.folder, self.n, self.files = f"{join.folder}/removed", join.n, Mapped()

    def of(self, docs: np.ndarray, hashes: np.ndarray) -> dict[int, list[int]]:
        """By text, the places of its removed lines."""
        where, found = _doc_range(docs, self.n), {}
        order = np.lexsort((docs, where))
        for k, a, b in _runs(where[order]):
            ids, rows = [self.files.get(f"{self.folder}/{k:06d}.{name}.npy") for name in ("doc", "rows")]
            if ids is None:
                continue
            some = order[a:b]
            left, right = (np.searchsorted(ids, docs[some], side=side) for side in ("left", "right"))
            there, of = rows[_ragged(left, right - left)], np.repeat(some, right - left)
            same = there["text_hash"] == hashes[of].view(np.int64)
            for i, line in zip(of[same].tolist(), there["line"][same].tolist()):
                found.setdefault(i, []).append(line)
        return found


def without_near_lines(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    share: tuple[int, int] = (4, 5),
    frequent: int = 256,
    long: int = 64,
) -> DataFrame:
    """Columns ``carry`` with ``n_lines, n_removed, kept_sha256`` and ``kept`` (the text left)."""
    join, found = matched_lines(docs.select("doc_id", "text"), share, frequent, long)
    n = join.n

    def ranged(frames):
        for frame in frames:
            frame["range_no"] = _doc_range(frame["doc"].to_numpy(np.int64), n)
            yield frame

    found.mapInPandas(ranged, "doc bigint, text_hash bigint, line int, range_no int").groupBy(
        "range_no").applyInPandas(_write_removed(join), "range_no int").count()
    for name in ("words", "sets"):  # what follows reads ``heads`` and ``removed`` alone
        shutil.rmtree(f"{join.folder}/{name}", ignore_errors=True)

    def cut(batches):
        heads, removed = Heads(join), Removed(join)

        for texts, ids in batches:
            out = {"n_lines": [], "n_removed": [], "kept_sha256": [], "kept": []}
            hashes = _text_hashes(texts)
            copies, n_lines = heads.copies(texts, ids, hashes)
            matched = removed.of(np.array([int(LAST) if doc is None else doc for doc in ids], np.int64), hashes)
            for i, raw in enumerate(texts):
                kept, gone = raw or b"", {*matched.get(i, ()), *copies.get(i, ())}
                if gone:
                    kept = b"\n".join([line for at, line in enumerate(raw.split(b"\n")) if at not in gone])
                out["n_lines"].append(n_lines[i])
                out["n_removed"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode("utf-8", "replace"))
            yield out

    rows = docs.select(F.struct(*dict.fromkeys(carry)).alias("row"), F.col("doc_id").cast("long").alias("id"), "text")
    made = map_texts(rows, cut, "n_lines bigint, n_removed bigint, kept_sha256 string, kept string", ("row",), beside="id")
    return made.select("row.*", "n_lines", "n_removed", "kept_sha256", "kept")
