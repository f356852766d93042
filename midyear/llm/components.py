"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from midyear.sources.shared import cut_lineage


def component_stars(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) as stars: each node but the least of its component, with that least node.

    Every round writes its links to the shared folder; nothing but two totals reaches the
    driver.  A node with very many links is reduced to its least neighbour by partial minima,
    and its links meet that minimum in a join whose large partitions are split at run time.
    """
    now = cut_lineage(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(low, "a")
        small = met.select("a", F.col("m").alias("b")).union(
            met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = cut_lineage(small.distinct())
        total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if total == seen:
            return now
        seen = total
