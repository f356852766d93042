"""Order-dependent operators: sections, forward fill, previous row, first rows.

A sheet has a meaning only in row order, so these operators take an explicit integer
order column, unique within its group.  A plain window over the group would put a
group that holds a third of all rows into one task.  Instead the rows are range-partitioned
by group and order and written once with the number of their partition: these chunks hold
about as many rows each, however the rows are spread over groups and order values.  Windows
run inside a chunk, each chunk of a group is summarised by one row, and the running state of
earlier chunks, a row per partition at most, is joined back.  The result is the same for any
number of chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from midyear.sources.shared import cut_lineage

# Group keys are held in one struct: structs compare NULL fields as equal, so windows
# and the join back share one hash partitioning, also for NULL keys.
GROUP = "__group"
CHUNK = "__chunk"


def place(df: DataFrame, group: Sequence[str], order: str, chunks: int | None = None) -> DataFrame:
    """``df`` cut into chunks of consecutive rows (runs a job that writes it to the shared folder).

    Rows already placed stay as they are.  ``chunks`` defaults to the shuffle partitions.
    """
    if CHUNK in df.columns:
        return df
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn(GROUP, F.struct(*group)).repartitionByRange(n, *group, order)
    return cut_lineage(ranged.withColumn(CHUNK, F.spark_partition_id()))


def _row_window(order: str):
    return Window.partitionBy(GROUP, CHUNK).orderBy(order)


def _earlier_chunks():
    by_chunk = Window.partitionBy(GROUP).orderBy(CHUNK)
    return by_chunk.rowsBetween(Window.unboundedPreceding, -1)


def sections(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    starts: Column,
    carry: Mapping[str, Column] | None = None,
    section: str = "section",
    section_start: str = "section_start",
    chunks: int | None = None,
) -> DataFrame:
    """Number the sections of each group and fill values of their first row forward.

    A row where ``starts`` is true opens a section; rows before the first one are
    section 0, headed by the first row of the group.  Adds ``section`` (LONG),
    ``section_start`` (order value of the head row) and one column per ``carry`` entry.
    """
    carry = dict(carry or {})
    flag = F.coalesce(starts, F.lit(False))
    head = F.struct(F.col(order).alias("at"), *[c.alias(name) for name, c in carry.items()])
    df = place(df, group, order, chunks)
    rows = df.withColumns({"__start": flag, "__head": head})

    upto = _row_window(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = rows.groupBy(GROUP, CHUNK).agg(
        F.count_if("__start").alias("__n"),
        F.max(F.when(F.col("__start"), F.col("__head"))).alias("__last_head"),
        F.min("__head").alias("__first_row"),
    )
    up_to_chunk = Window.partitionBy(GROUP).orderBy(CHUNK).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    states = states.select(
        GROUP,
        CHUNK,
        F.coalesce(F.sum("__n").over(_earlier_chunks()), F.lit(0)).alias("__before"),
        F.last("__last_head", ignorenulls=True).over(_earlier_chunks()).alias("__open"),
        F.first("__first_row").over(up_to_chunk).alias("__first_row"),
    )
    rows = rows.withColumns(
        {
            "__count": F.count_if("__start").over(upto),
            "__seen": F.last(F.when(F.col("__start"), F.col("__head")), ignorenulls=True).over(
                upto),
        }
    )
    joined = rows.join(states, [GROUP, CHUNK])
    filled = F.coalesce("__seen", "__open", "__first_row")
    out = joined.withColumn("__fill", filled).withColumns(
        {
            section: F.col("__before") + F.col("__count"),
            section_start: F.col("__fill.at"),
            **{name: F.col(f"__fill.{name}") for name in carry},
        }
    )
    keep = [c for c in df.columns if c not in {GROUP, CHUNK, section, section_start, *carry}]
    return out.select(*keep, section, section_start, *carry)


def previous(df: DataFrame, group: Sequence[str], order: str, value: str, into: str,
             chunks: int | None = None) -> DataFrame:
    """Value of the preceding row of the group; NULL on the first row.

    The chunks of rows that came placed stay on them, for the next operator.
    """
    rows = place(df, group, order, chunks)
    tails = rows.groupBy(GROUP, CHUNK).agg(
        F.max(F.struct(F.col(order).alias("at"), F.col(value).alias("v"))).alias("__tail")
    )
    last_before = F.lag("__tail").over(Window.partitionBy(GROUP).orderBy(CHUNK))
    tails = tails.select(GROUP, CHUNK, last_before.alias("__tail"))
    inside = F.lag(F.struct(F.col(value).alias("v"))).over(_row_window(order))
    joined = rows.withColumn("__inside", inside).join(tails, [GROUP, CHUNK])
    before = F.when(F.col("__inside").isNotNull(), F.col("__inside.v")).otherwise(
        F.col("__tail.v")
    )
    return joined.withColumn(into, before).select(*df.columns, into)


def numbered(df: DataFrame, group: Sequence[str], order: str, into: str,
             chunks: int | None = None) -> DataFrame:
    """1-based row number within each group."""
    every = sections(df, group, order, F.lit(True), section=into, section_start="__at",
                     chunks=chunks)
    return every.drop("__at")


def first_rows(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """The first row of each group, by aggregation (partial minimum before the shuffle)."""
    row = F.struct(order, *[c for c in df.columns if c != order])
    best = df.groupBy(*group).agg(F.min_by(row, order).alias("__row"))
    return best.select("__row.*").select(*df.columns)


def without_first(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Drop the first row of each group."""
    lowest = df.groupBy(F.struct(*group).alias(GROUP)).agg(F.min(order).alias("__lowest"))
    marked = df.withColumn(GROUP, F.struct(*group)).join(lowest, GROUP)
    return marked.filter(F.col(order) > F.col("__lowest")).select(*df.columns)


def overwrite_first(df: DataFrame, group: Sequence[str], order: str, target: str,
                    value: Column) -> DataFrame:
    """Replace ``target`` on the first row of each group."""
    lowest = df.groupBy(F.struct(*group).alias(GROUP)).agg(F.min(order).alias("__lowest"))
    marked = df.withColumn(GROUP, F.struct(*group)).join(lowest, GROUP)
    changed = F.when(F.col(order) == F.col("__lowest"), value).otherwise(F.col(target))
    return marked.withColumn(target, changed).select(*df.columns)
