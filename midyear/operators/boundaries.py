"""As-of-forward joins: each event meets the next boundary of its key, from a table of any dates.

Events and boundaries are one ordered table, range-partitioned by key and date and written once, so a
key with a third of all rows is spread over many chunks.  Inside a chunk the nearest boundary ahead is
carried backward; a chunk is summed up by its first boundary, and rows after which their chunk has none
take that of the nearest later chunk of their key.  No pair of an event and a boundary is formed but the
one that is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from midyear.operators.ordered import CHUNK, GROUP
from midyear.operators.shape import row_salt
from midyear.sources.shared import cut_lineage


def next_from_table(
    events: DataFrame,
    boundaries: DataFrame,
    on: Sequence[str],
    at: str,
    boundary: str,
    carry: Sequence[str] = (),
    strict: bool = True,
    chunks: int | None = None,
) -> DataFrame:
    """Events with ``boundary``, the first of their key after ``at``, and the columns ``carry`` of its row.

    Keys match NULL with NULL.  ``strict`` leaves out a boundary on the day itself.  Events without a
    date, or after the last boundary, have NULL; NULL boundaries meet nothing; of several rows for one
    boundary the least ``carry`` counts.  Runs a job that writes both tables once.
    """
    n = chunks or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = boundaries.filter(F.col(boundary).isNotNull()).groupBy(*on, boundary).agg(
        F.min(F.struct(*carry) if carry else F.lit(0)).alias("__carry"))
    kind = events.schema[at].dataType
    ahead = F.struct(F.col(boundary).alias("at"), F.col("__carry").alias("carry"))
    marks = once.select(
        F.struct(*on).alias(GROUP), F.col(boundary).cast(kind).alias("__at"), F.lit(0 if strict else 1).alias("__kind"),
        F.lit(0).alias("__salt"), ahead.alias("__ahead"))
    rows = events.select(
        F.struct(*on).alias(GROUP), F.col(at).alias("__at"), F.lit(1 if strict else 0).alias("__kind"),
        row_salt(events, 1 << 20).alias("__salt"), F.struct("*").alias("__row"))
    both = marks.unionByName(rows, allowMissingColumns=True)
    ranged = both.repartitionByRange(n, GROUP, "__at", "__kind", "__salt")
    placed = cut_lineage(ranged.withColumn(CHUNK, F.spark_partition_id()))

    backward = Window.partitionBy(GROUP, CHUNK).orderBy(F.desc("__at"), F.desc("__kind")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy(GROUP).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy(GROUP, CHUNK).agg(F.min("__ahead").alias("__first")).select(
        GROUP, CHUNK, F.last("__first", ignorenulls=True).over(later).alias("__later"))
    seen = placed.withColumn("__seen", F.last("__ahead", ignorenulls=True).over(backward)).filter("__row IS NOT NULL")
    met = seen.join(first, [GROUP, CHUNK]).withColumn(
        "__next", F.when(F.col("__at").isNotNull(), F.coalesce("__seen", "__later")))
    kept = [c for c in events.columns if c != boundary and c not in carry]
    return met.select(*[F.col(f"__row.`{c}`") for c in kept], F.col("__next.at").alias(boundary),
                      *[F.col(f"__next.carry.`{c}`") for c in carry])
