"""Bands as intervals of an ordered domain, read from a table.

A band's total is a difference of two prefix sums: that up to its upper end less that below its lower
end.  Values are totalled per key and position first; the ends of the bands join them as rows of their
own, and one pass over the ordered rows, in chunks that any key may span, gives every end its prefix.
The work grows with positions and bands, not with how many positions the bands cover.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from midyear.functions.numbers import known
from midyear.operators.ordered import CHUNK, GROUP, place
from midyear.operators.shape import expand_over

#: Decimals that sums of doubles are held to, so that differences of large prefixes lose nothing.
SCALE = 12


def running_totals(df: DataFrame, group: Sequence[str], order: str, values: Sequence[str],
                   chunks: int | None = None) -> DataFrame:
    """``values`` added up in order within each group; sums of whole numbers and decimals are exact.

    Runs a job that writes the rows in chunks.  Rows with one order value count in any order.
    """
    rows = place(df, group, order, chunks)
    names = [f"__sum_{i}" for i in range(len(values))]
    sums = rows.groupBy(GROUP, CHUNK).agg(*[F.sum(v).alias(s) for v, s in zip(values, names)])
    earlier = Window.partitionBy(GROUP).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(GROUP, CHUNK, *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(s) for s in names])
    inside = Window.partitionBy(GROUP, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = rows.withColumns({v: F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    joined = added.join(before, [GROUP, CHUNK])
    return joined.withColumns({v: F.col(v) + F.col(s) for v, s in zip(values, names)}).select(*df.columns)


def interval_rollup(df: DataFrame, keys: Sequence[str], position: str, value: str, bands: DataFrame,
                    chunks: int | None = None) -> DataFrame:
    """``keys, band, value``: totals of the bands ``(band, low, high)``, both ends included.

    Bands may overlap; one of several intervals has a row for each, repeated rows count once.  A band without rows of a key is
    absent for it, one with a NULL or NaN value among them is NULL.  Rows without a position and
    intervals without an end are in no band.  Keys match NULL with NULL.  Runs jobs.
    """
    kind = df.schema[value].dataType
    whole = kind.typeName() in ("byte", "short", "integer", "long")
    exact = "decimal(38,0)" if whole else kind.simpleString() if kind.typeName() == "decimal" else f"decimal(38,{SCALE})"
    c = F.col(f"`{value}`")
    good = c.isNotNull() if kind.typeName() not in ("double", "float") else known(c)
    base = df.filter(F.col(position).isNotNull()).groupBy(*keys, F.col(position).alias("__at")).agg(
        F.sum(F.when(good, c).cast(exact)).cast("decimal(38,12)" if not whole else exact).alias("__v"),
        F.count(F.lit(1)).alias("__n"), F.count_if(~good).alias("__bad"))
    spot = F.struct(F.col("__at"), F.lit(1).alias("turn"))
    rows = base.select(*keys, spot.alias("__spot"), F.coalesce("__v", F.lit(0)).alias("__v"), "__n", "__bad")

    at = df.schema[position].dataType
    ends = bands.filter(F.col("low") <= F.col("high")).select(F.struct(
        "band", F.col("low").cast(at).alias("low"), F.col("high").cast(at).alias("high")).alias("__band"))
    owned = expand_over(base.select(*keys).distinct(), ends, "__band")
    # the lower end stands before the rows of its position, the upper end behind them
    edge = F.explode(F.array(
        F.struct(F.struct(F.col("__band.low").alias("__at"), F.lit(0).alias("turn")).alias("__spot"), F.lit(-1).alias("sign")),
        F.struct(F.struct(F.col("__band.high").alias("__at"), F.lit(2).alias("turn")).alias("__spot"), F.lit(1).alias("sign"))))
    edges = owned.withColumn("__edge", edge).select(
        *keys, "__edge.__spot", F.col("__band.band").alias("band"), F.col("__edge.sign").alias("__sign"))
    running = running_totals(
        rows.unionByName(edges, allowMissingColumns=True), keys, "__spot", ["__v", "__n", "__bad"], chunks)
    sign = F.col("__sign")
    totals = running.filter("__sign IS NOT NULL").groupBy(*keys, "band").agg(
        F.sum(F.col("__v") * sign).alias("__v"), F.sum(F.col("__n") * sign).alias("__n"),
        F.sum(F.col("__bad") * sign).alias("__bad"))
    out = F.when(F.col("__bad") == 0, F.col("__v")).cast("bigint" if whole else kind)
    return totals.filter(F.col("__n") > 0).select(*keys, "band", out.alias(value))
