"""The prefix trie of rebuilt conversations, found with vertical bitmaps.

A conversation is rebuilt from the first turns of another one and its own later turns.  Conversations
in id order make up shards; a shard holds, for each (position, turn), the bitset of its conversations
with that turn there.  From a node's bitset a depth-first walk takes the turn of its lowest member at
the next position, intersects the bitset with that posting, which is a child, takes its members away
and goes on until none is left: one intersection a child.  Popcounts are member counts, and the bitset
of conversations of a length, cut with a node's, lists those that end there.  The nodes of all shards
meet by a digest of their path; sums over subtrees double their reach round by round.

Nothing is gathered per conversation: turns become digests, long conversations are cut into stretches
of ``stretch`` turns that are walked apart, from the digest of the path before them.  A node's list of
ends is hashed as a stream, shard by shard.

Nulls: a null turn comes first, null roles and texts count as empty; rows without a conversation id
name no conversation and take no part.  Turns with one number are ordered by the digest of role and
text, repeated rows are turns each.  Empty and very long texts are turns like others.  No conversation
at all gives no node, not even a root.  Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from midyear.sources.shared import cut_lineage

#: Turns of a conversation walked at once; conversations and turns of a shard.
STRETCH = 1024
SHARD_CONVERSATIONS, SHARD_TURNS = 4096, 200_000
#: Digest of the empty path.
ROOT = bytes(16)

_TURNS = "array<struct<digest:binary,size:bigint>>"


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from another one: crc32 of its id as text, modulo 9."""
    return (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")


def step(path: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(path + turn).digest()[:16]


def stretch_digest(turns: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(turns)).digest()[:16]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv, start, n, turns``: the turns of each conversation in order, in pieces.

    Rows are range-partitioned by conversation and turn, so a conversation with a third of all rows has
    pieces in many partitions: ``start`` is the place of a piece's first turn, ``n`` counts all turns.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = cut_lineage(conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"),
        F.unhex(F.substring(F.sha2(said.cast("binary"), 256), 1, 32)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size")))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "conv", "turn", "digest").withColumn("part", F.spark_partition_id())
    found = F.sort_array(F.collect_list(F.struct("turn", "digest", "size")))  # nulls first
    pieces = cut_lineage(ranged.groupBy("conv", "part").agg(found.alias("found")).select(
        "conv", "part", F.transform("found", lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("turns")))
    sizes = pieces.select("conv", "part", F.size("turns").cast("bigint").alias("m"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "conv", "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("start"),
        F.sum("m").over(Window.partitionBy("conv")).alias("n"))
    return pieces.join(starts, ["conv", "part"]).select("conv", "start", "n", "turns")


def rebuilt(pieces: DataFrame, every: int = 5, taken: int = 8) -> DataFrame:
    """``conv, start, n, turns`` of the rebuilt conversations; one without a turn is an empty piece.

    A conversation takes its first ``shared_turns`` turns, ``taken`` at most, from the one whose id is
    the next lower multiple of ``every``.
    """
    heads = pieces.filter((F.col("conv") % every == 0) & (F.col("start") < taken)).groupBy(
        F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("start", F.slice(
            "turns", F.lit(1), F.lit(taken)).alias("turns")))).alias("found"))
    heads = heads.select("base", F.slice(F.flatten(F.transform("found", lambda x: x["turns"])), 1, taken).alias("head"))
    own = pieces.withColumns({"base": F.col("conv") - F.col("conv") % every, "h": shared_turns(F.col("conv"))})
    met = own.join(heads, "base", "left").withColumn(
        "head", F.slice(F.coalesce("head", F.array().cast(_TURNS)), F.lit(1), F.col("h")))
    skipped = F.greatest(F.col("h") - F.col("start"), F.lit(0)).cast("int")
    tail = F.slice("turns", skipped + 1, F.greatest(F.size("turns") - skipped, F.lit(0)))
    first = F.col("start") == 0
    return met.select(
        "conv",
        F.when(first, F.lit(0)).otherwise(F.greatest("start", "h") - F.col("h") + F.size("head")).cast("bigint").alias("start"),
        (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("bigint").alias("n"),
        F.when(first, F.concat("head", tail)).otherwise(tail).alias("turns"))


def stretches(pieces: DataFrame, stretch: int) -> DataFrame:
    """``conv, k, path, n, turns``: whole conversations, or stretches of them from ``k * stretch`` on.

    ``path`` is the digest of the turns before.  Only conversations of more than one stretch or piece
    are dealt anew.
    """
    whole = (F.col("start") == 0) & (F.size("turns") == F.col("n")) & (F.col("n") <= stretch)
    short = pieces.filter(whole).select(
        "conv", F.lit(0).cast("bigint").alias("k"), F.lit(ROOT).alias("path"), "n", "turns")
    spread = pieces.filter(~whole).select("conv", "start", "n", F.posexplode("turns").alias("i", "turn")).withColumn(
        "at", F.col("start") + F.col("i"))
    cut = cut_lineage(spread.groupBy("conv", F.expr(f"at DIV {stretch}").alias("k"), "n").agg(
        F.array_sort(F.collect_list(F.struct("at", "turn"))).alias("found")).select(
            "conv", "k", "n", F.transform("found", lambda x: x["turn"]).alias("turns")))

    def digests(frames: Iterator[pd.DataFrame]):
        for frame in frames:
            yield pd.DataFrame({"conv": frame["conv"], "k": frame["k"],
                                "digest": [stretch_digest([t["digest"] for t in turns]) for turns in frame["turns"]]})

    def paths(frame: pd.DataFrame) -> pd.DataFrame:
        frame, path, out = frame.sort_values("k"), ROOT, []
        for digest in frame["digest"]:  # one value a stretch
            out.append(path)
            path = step(path, digest)
        return pd.DataFrame({"conv": frame["conv"], "k": frame["k"], "path": out})

    made = cut.mapInPandas(digests, "conv bigint, k bigint, digest binary")
    before = made.groupBy("conv").applyInPandas(paths, "conv bigint, k bigint, path binary")
    return short.unionByName(cut.join(before, ["conv", "k"]).select("conv", "k", "path", "n", "turns"))


def shard_nodes(rows: list[tuple], stretch: int) -> list[tuple]:
    """The nodes of a shard of ``(conv, k, path, n, turns)`` rows in id order, turns as (digest, size).

    ``(path, parent, depth, first, members, size, ends)`` each: the digests of the node and its parent,
    its lowest conversation, how many it has here, the bytes of its last text, and the conversations
    that end there, as text.  Starts of later stretches are nodes of other shards.
    """
    postings: list[dict[bytes, int]] = []
    ending: dict[int, int] = {}
    starts: dict[tuple, int] = {}
    for bit, (_, k, path, n, turns) in enumerate(rows):
        mark = 1 << bit
        starts[k, path] = starts.get((k, path), 0) | mark
        if n <= k * stretch + len(turns):
            ending[k * stretch + len(turns)] = ending.get(k * stretch + len(turns), 0) | mark
        for at, (digest, _) in enumerate(turns):
            if at == len(postings):
                postings.append({})
            postings[at][digest] = postings[at].get(digest, 0) | mark
    longer = [0] * (len(postings) + 1)
    for at, posting in enumerate(postings):
        for members in posting.values():
            longer[at] |= members

    def ends(members: int, depth: int) -> str | None:
        left, out = members & ending.get(depth, 0), []
        while left:
            low = left & -left
            out.append(str(rows[low.bit_length() - 1][0]))
            left ^= low
        return ",".join(out) or None

    nodes = []
    for (k, path), members in starts.items():
        if k == 0:
            first = (members & -members).bit_length() - 1
            nodes.append((path, None, 0, rows[first][0], members.bit_count(), 0, ends(members, 0)))
        stack = [(path, members, 0)]
        while stack:
            parent, members, at = stack.pop()
            left = members & longer[at]
            while left:
                first = (left & -left).bit_length() - 1
                turns = rows[first][4]
                digest, size = turns[at]
                child = left & postings[at][digest]
                left ^= child
                if at + 1 == stretch:  # named as the stretch after it names its start
                    node = step(path, stretch_digest([d for d, _ in turns]))
                else:
                    node = step(parent, digest)
                    stack.append((node, child, at + 1))
                depth = k * stretch + at + 1
                nodes.append((node, parent, depth, rows[first][0], child.bit_count(), size, ends(child, depth)))
    return nodes


_NODE = ["path", "parent", "depth", "first", "members", "size", "ends"]


def _walk(parts: DataFrame, stretch: int, conversations: int, turns: int) -> DataFrame:
    """Nodes of all shards: stretches in order of place and id, cut as they come."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = parts.repartitionByRange(n, "k", "conv").sortWithinPartitions("k", "conv")

    def walk(frames: Iterator[pd.DataFrame]):
        held, size = [], 0
        for frame in frames:
            for conv, k, path, total, found in frame.itertuples(index=False):
                held.append((int(conv), int(k), bytes(path), int(total), [(t["digest"], t["size"]) for t in found]))
                size += len(found)
                if len(held) == conversations or size >= turns:
                    yield pd.DataFrame(shard_nodes(held, stretch), columns=_NODE)
                    held, size = [], 0
        if held:
            yield pd.DataFrame(shard_nodes(held, stretch), columns=_NODE)

    return ranged.mapInPandas(
        walk, "path binary, parent binary, depth bigint, first bigint, members bigint, size bigint, ends string")


def _ends(found: DataFrame) -> DataFrame:
    """``path, ends_sha256``: the lists of a node's shards hashed in id order, as they come."""
    lists = found.filter(F.col("ends").isNotNull()).select(
        "path", F.split("ends", ",")[0].cast("bigint").alias("low"), "ends")

    def hashed(frames: Iterator[pd.DataFrame]):
        path, running = None, None
        for frame in frames:
            done = []
            for node, ends in zip(frame["path"], frame["ends"]):
                if node != path:
                    if running is not None:
                        done.append((path, running.hexdigest()))
                    path, running = node, hashlib.sha256(ends.encode())
                else:
                    running.update(b"," + ends.encode())
            yield pd.DataFrame(done, columns=["path", "ends_sha256"])
        if running is not None:
            yield pd.DataFrame([(path, running.hexdigest())], columns=["path", "ends_sha256"])

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lists.repartition(n, "path").sortWithinPartitions("path", "low").select("path", "ends")
    return dealt.mapInPandas(hashed, "path binary, ends_sha256 string")


def _subtrees(nodes: DataFrame) -> DataFrame:
    """``path, n_leaves, saved_tokens`` summed over subtrees, in as many rounds as the depth has bits.

    After r rounds a node has the sums of all nodes less than ``2 ** r`` below it and knows its ancestor
    ``2 ** r`` above; nodes add their sums to that ancestor.
    """
    state = nodes.select(
        "path", F.col("parent").alias("up"), "depth", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    deepest, reach = nodes.agg(F.max("depth")).first()[0] or 0, 1
    while reach <= deepest:
        far = state.filter(F.col("depth") >= reach)
        added = far.groupBy(F.col("up").alias("path")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        ups = far.select(F.col("path").alias("up"), F.col("up").alias("next"))
        # only a node at least twice as deep has an ancestor that far up
        climbing = state.filter(F.col("depth") >= 2 * reach).join(ups, "up", "left").drop("up").withColumnRenamed("next", "up")
        moved = climbing.select(*state.columns).union(
            state.filter(F.col("depth") < 2 * reach).withColumn("up", F.lit(None).cast("binary")))
        state = cut_lineage(moved.join(added, "path", "left").select(
            "path", "up", "depth", (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens")))
        reach *= 2
    return state.select("path", "n_leaves", "saved_tokens")


def prefix_trie(
    conversations: DataFrame,
    stretch: int = STRETCH,
    shard_conversations: int = SHARD_CONVERSATIONS,
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row a node of the trie of the rebuilt conversations; see the module for the method.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``, and the
    digests ``path`` and ``parent``.  Runs jobs.
    """
    parts = stretches(rebuilt(ordered_turns(conversations)), stretch)
    found = cut_lineage(_walk(parts, stretch, shard_conversations, shard_turns))
    met = cut_lineage(found.groupBy("path").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("first").alias("conv_id"),
        F.sum("members").alias("n_convs"), F.max("size").alias("size")))
    children = met.filter("depth > 0").groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(met.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    top = nodes.filter("depth = 0").select("conv_id").first()
    above = nodes.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.filter("depth > 1").join(above, "parent").unionByName(  # the root has one id, as all have it
        nodes.filter("depth <= 1").withColumn("parent_conv_id", F.when(
            F.col("depth") == 1, F.lit(top[0] if top else None)).cast("bigint")))
    out = known.join(_subtrees(nodes), "path").join(_ends(found), "path", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"), "path", "parent")
