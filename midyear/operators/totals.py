"""Grouped sums, counts, shares and means with explicit null rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.numbers import share, strict_sum, sum_of
from midyear.operators.joins import join_on


def group_sum(df: DataFrame, keys: Sequence, value: str, into: str | None = None) -> DataFrame:
    """Grouped sum that is NULL when any value of the group is NULL; sums of doubles do not depend on the
    order of rows."""
    return df.groupBy(*keys).agg(strict_sum(F.col(value), sum_of(df, value)).alias(into or value))


def group_count(df: DataFrame, keys: Sequence, into: str = "n",
                weight: str | None = None) -> DataFrame:
    """Grouped count, or the sum of a weight column.  Keys may be expressions."""
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(measure.alias(into))


def group_mean(df: DataFrame, keys: Sequence, value: str, into: str | None = None) -> DataFrame:
    """Unweighted mean of the rows present; one NaN makes the mean NaN.  The order of rows does not matter."""
    whole = F.avg(value) if df.schema[value].dataType.typeName() not in ("double", "float") else (
        sum_of(df, value) / F.count(F.col(value)))
    mean = F.when(F.count(F.col(value)) == F.count(F.lit(1)), whole)
    return df.groupBy(*keys).agg(mean.alias(into or value))


def with_group_total(df: DataFrame, keys: Sequence[str], value: str,
                     into: str = "total") -> DataFrame:
    """The group total beside each row.

    Totals are aggregated map-side first and joined back, so that a group holding a large
    part of the rows is never sorted in one task as a window would.
    """
    totals = group_sum(df, keys, value, into)
    return join_on(df, totals, keys, "inner")


def share_of_total(df: DataFrame, keys: Sequence[str], value: str,
                   into: str = "proportion") -> DataFrame:
    """Each row's share of its group total."""
    total = "__total"
    joined = with_group_total(df, keys, value, total)
    return joined.withColumn(into, share(F.col(value), F.col(total))).drop(total)


def with_group_min(df: DataFrame, keys: Sequence[str], value: Column,
                   into: str) -> DataFrame:
    """A conditional minimum of the group beside each row."""
    lowest = df.groupBy(*keys).agg(F.min(value).alias(into))
    return join_on(df, lowest, keys, "inner")


def keep_group_min(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows that hold the minimum of their group, ties included."""
    joined = with_group_min(df, keys, F.col(value), "__lowest")
    return joined.filter(F.col(value) == F.col("__lowest")).drop("__lowest")
