"""Sources mixed to target weights by Sainte-Lague apportionment, on DataFrame functions alone.

Targets: sources by code point (null last) weigh ``weights`` in turn and share ``share`` times
all words; a target stops at ``most`` times its source's words and the excess goes to the others
by weight.  The words of all targets are cut into equal blocks; the blocks go to the sources with
the highest quotients target / (2 k + 1), and a source's blocks in the same way to its shards.
A shard is a hash range of documents of bounded size.  Inside it, documents stand in seeded
order as one line of words, and the leading blocks of that line are taken, after as many whole
passes as the quota holds.

Null texts and texts without words have size 0 and take 0.  Repeated rows are mixed each for
itself.  A null source is a source of its own.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from midyear.llm.texts import WORD, id_text
from midyear.sources.shared import cut_lineage

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """One row per source with ``source_size`` and ``target``.

    With sources in the order of the level at which they stop, the level that fills all
    targets is the largest of (words left) / (weight left) over the sources' turns.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    cases = F.when(turn == 0, weights[0])
    for i, weight in enumerate(weights[1:], 1):
        cases = cases.when(turn == i, weight)
    rows = totals.withColumn("weight", cases).withColumn("stop", F.col("source_size") * most)
    everything = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("stop").over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / weight_left)
    level = F.max("level").over(whole)
    return rows.withColumn("level", level).select(
        "source", "source_size",
        F.least(F.col("stop").cast("double"), F.col("weight") * F.col("level")).alias("target"),
    )


def sainte_lague(rows: DataFrame, group: list[str], order: list[str], weight: str, seats: str) -> DataFrame:
    """``rows`` with their ``quota``: ``seats`` of each group go to the highest weight / (2 k + 1).

    A divisor that surely gives too few seats and one that surely gives enough bound the seats
    of each row, so that two quotients a row are ranked on average, however many seats there are.
    """
    names = list(rows.columns)
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    total, half = F.sum(weight).over(whole), F.count(F.lit(1)).over(whole) / 2.0
    few, many = F.col(seats) - half - 1, F.col(seats) + half + 1
    least = F.when((few > 0) & (total > 0), F.floor(F.col(weight) * few / total + 0.5)).otherwise(0)
    enough = F.when(total > 0, F.floor(F.col(weight) * many / total + 0.5)).otherwise(0)
    bounds = rows.withColumn("_least", least.cast("long")).withColumn("_enough", enough.cast("long"))
    bounds = bounds.withColumn("_open", F.col(seats) - F.sum("_least").over(whole))
    turns = F.when(F.col("_enough") > F.col("_least"), F.sequence("_least", F.col("_enough") - 1))
    tried = bounds.withColumn("_turn", F.explode_outer(turns))
    best = Window.partitionBy(*(group or [F.lit(0)])).orderBy(
        (F.col(weight) / (2 * F.col("_turn") + 1)).desc_nulls_last(),
        *[F.col(name).asc_nulls_last() for name in order], "_turn")
    tried = tried.withColumn("_rank", F.row_number().over(best))
    won = F.sum(F.when(F.col("_turn").isNotNull() & (F.col("_rank") <= F.col("_open")), 1).otherwise(0))
    return tried.groupBy(*names, "_least").agg(won.alias("_won")).select(
        *names, (F.col("_least") + F.col("_won")).alias("quota"))


def _seeded(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), id_text(doc_id)).cast("binary"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    block_words: int = 50,
    shard_words: int = 250_000,
    seed: int = 7,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``source, shard, quota`` per document, and ``carry``."""
    sizes = cut_lineage(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        _seeded(F.col("doc_id"), seed).alias("place"), *carry,
    ))
    targets = source_targets(sizes, weights, share, most)
    targets = targets.withColumn("blocks", F.round(
        F.sum("target").over(Window.partitionBy(F.lit(0))) / block_words).cast("long"))
    targets = targets.withColumn(
        "n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    targets = sainte_lague(targets, [], ["source"], "target", "blocks")
    targets = cut_lineage(targets.withColumnRenamed("quota", "source_quota").drop("blocks"))
    key = targets.withColumnRenamed("source", "_source")
    placed = sizes.join(key, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    number = F.conv(F.substring("place", 1, 12), 16, 10).cast("long")
    placed = placed.withColumn("shard", number % F.col("n_shards"))
    shards = placed.groupBy("source", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    quotas = cut_lineage(sainte_lague(shards, ["source"], ["shard"], "shard_size", "source_quota"))
    quotas = quotas.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "shard_size", "quota")
    rows = placed.join(
        quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    line = Window.partitionBy("source", "shard").orderBy(
        F.substring("place", 13, 20), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum("size").over(line) - F.col("size")
    words = F.least(F.col("quota") * block_words, F.col("shard_size") * most)
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0)
    rows = rows.withColumn("start", start).withColumn("words", words).withColumn("passes", passes)
    rest = F.col("words") - F.col("passes") * F.col("shard_size") - F.col("start")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return rows.select(
        "doc_id", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + part).cast("long").alias("taken"),
        "source", "shard", "quota", *carry,
    )
