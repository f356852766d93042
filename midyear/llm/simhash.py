"""SimHash near-duplicates, found by vantage-point trees over the fingerprints.

Fingerprints are those of the contract: A-Z lowered, ``shingle`` words, repeats included, XXH64 with
seed 42; a bit is set if it is in over half the hashes.  Fewer words make one shingle; no words, or
a null text, make fingerprint zero, which is linked like any other.

Equal fingerprints are one point.  A tree grown on a sample of about ``sample`` points at most routes
every point to its shards, a point near a boundary to both sides; each shard splits on by its own
tree and links its close points exactly.  Links across shards are joined in components.
Documents without an id belong to the component of their fingerprint; a component in which no
document has an id has a null id.  Repeated rows are documents each.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from midyear.llm.components import component_stars
from midyear.llm.texts import map_texts
from midyear.llm.vptree import build_tree, close_stars, route
from midyear.sources.shared import cut_lineage


def fingerprint(raw: bytes | None, shingle: int = 3, block: int = 100_000) -> int:
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    span = min(shingle, len(words))
    counts = np.zeros(64, np.int64)
    n = len(words) - span + 1
    for first in range(0, n, block):
        some = words[first : first + block + span - 1]
        joined = map(b" ".join, zip(*[some[i:] for i in range(span)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(42)), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, carry: tuple[str, ...], shingle: int = 3) -> DataFrame:
    """Columns ``carry`` and ``point``: the fingerprint's 64 bits as a signed number."""

    def work(batches):
        for texts in batches:
            yield {"point": [fingerprint(raw, shingle) for raw in texts]}

    return map_texts(docs, work, "point bigint", carry)


def close_links(points: DataFrame, reach: int, shard_points: int, sample: int) -> DataFrame:
    """Links (a, b) that join all distinct ``points`` within ``reach`` bits."""
    n = points.count()
    place = F.pmod(F.xxhash64("point"), F.lit(1 << 30)) / float(1 << 30)
    taken = points.filter(place < sample / max(1, n)).select("point").collect()  # about ``sample`` at most
    tree = build_tree(np.array([r[0] for r in taken], np.int64).view(np.uint64), n, shard_points, reach)

    def to_shards(frames):
        for frame in frames:
            values = frame["point"].to_numpy(np.int64)
            for leaf, at in route(values.view(np.uint64), tree, reach):
                yield pd.DataFrame({"shard": leaf, "point": values[at]})

    def links(frame):
        found = close_stars(frame["point"].to_numpy(np.int64).view(np.uint64), reach)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    routed = points.select("point").mapInPandas(to_shards, "shard int, point bigint")
    return routed.groupBy("shard").applyInPandas(links, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    shingle: int = 3,
    reach: int = 2,
    shard_points: int = 8192,
    sample: int = 32_768,
) -> DataFrame:
    """Columns ``carry`` with ``fingerprint`` (16 hex digits), ``component_id`` and ``root``.

    ``root`` is the least fingerprint of the component, as a signed number: it tells components apart
    also where ids are missing or stand in several of them.
    """
    rows = with_fingerprints(docs.select(*dict.fromkeys([*carry, "text"])), carry, shingle)
    held = cut_lineage(rows.select(F.struct(*carry).alias("row"), F.col("doc_id").alias("id"), "point"))
    points = cut_lineage(held.groupBy("point").agg(F.min("id").alias("first")))
    stars = component_stars(close_links(points, reach, shard_points, sample))
    members = stars.select(F.col("a").alias("point"), F.col("b").alias("root")).union(
        stars.select(F.col("b").alias("point"), F.col("b").alias("root")).distinct())
    members = members.join(points, "point")
    least = members.groupBy("root").agg(F.min("first").alias("least"))
    linked = cut_lineage(members.join(least, "root").select("point", "least", "root"))
    groups = points.join(linked, "point", "left").select(
        "point", F.coalesce("root", "point").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("least")).otherwise(F.col("first")).alias("component_id"))
    return held.join(groups, "point").select(
        "row.*", F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"), "component_id", "root")


def first_of_each(docs: DataFrame, shingle: int = 3, reach: int = 2) -> DataFrame:
    """``docs`` without near-duplicates: of each component the document with the least id.

    Rows without an id come after those with one; of rows with one id, that with the least hash of its
    text stays, and one of equal rows.  Components are told apart by their root fingerprints, so an id
    that stands in several of them, or in none, costs no document.  Groups are found without the texts,
    which are joined once at the end.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = near_duplicates(rows, ("doc_id", "text_hash"), shingle, reach)
    texts = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n"))
    kept = cut_lineage(texts.groupBy("root").agg(first.alias("least")).select(
        F.col("least.doc_id").alias("_id"), F.col("least.text_hash").alias("_hash"), F.col("least.n").alias("_n")))
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"))
    met = whole.join(kept, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")))
    once = met.filter("_n = 1").select("doc")
    if kept.filter("_n > 1").limit(1).count():
        once = once.union(met.filter("_n > 1").groupBy("_id", "_hash").agg(F.first("doc").alias("doc")).select("doc"))
    return once.select("doc.*")
