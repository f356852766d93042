"""Projections, unions, reshaping and row generation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.text import ascii_text


def select_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename: new name to old name."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])


def move_first(df: DataFrame, *first: str, drop: Sequence[str] = ()) -> DataFrame:
    """Named columns first, then everything else, without ``drop``."""
    rest = [c for c in df.columns if c not in first and c not in drop]
    return df.select(*first, *rest)


def select_like(df: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of another table, in its order."""
    return df.select(*other.columns)


def derive(df: DataFrame, **steps: Column) -> DataFrame:
    """Add columns left to right: a later step sees the result of an earlier one, also
    when that step replaced a column."""
    for name, expression in steps.items():
        df = df.withColumn(name, expression)
    return df


def derive_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that are evaluated once per row.

    Catalyst pushes a filter below the projection it reads from by copying the projected
    expression into it, so a parsed date would be parsed again in every filter and in every
    inferred null check.  Filters are not copied through a generator, hence the one-row
    ``inline``.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[expression.alias(name) for name, expression in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(row)))


def map_columns(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """One expression applied to several columns."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def normalise_names(df: DataFrame, spaces: bool = True) -> DataFrame:
    """Column names to ASCII lower case, with runs of spaces as ``_`` if ``spaces``."""
    def norm(name: str) -> str:
        name = ascii_text(name).lower()
        if spaces:
            while "  " in name:
                name = name.replace("  ", " ")
            name = name.replace(" ", "_")
        return name

    return df.toDF(*[norm(c) for c in df.columns])


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 key: str = "variable", value: str = "value") -> DataFrame:
    """One row per id and value column; NULL values are kept."""
    return df.unpivot(list(ids), list(values), key, value)


def split_key(df: DataFrame, key: str, into: Mapping[str, str], pattern: str) -> DataFrame:
    """Split a key into typed columns; extra pieces are dropped, missing ones are NULL,
    pieces that do not convert are NULL."""
    pieces = F.split(F.col(key), pattern)
    typed = {
        name: F.get(pieces, F.lit(i)).try_cast(kind)
        for i, (name, kind) in enumerate(into.items())
    }
    return df.withColumns(typed).drop(*[c for c in [key] if c not in into])


def union_by_name(*tables: DataFrame) -> DataFrame:
    """UNION ALL by name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def nest(df: DataFrame, keys: Sequence[str], into: str = "data") -> DataFrame:
    """The rows of each key as an array of structs of all other columns, repeated rows included.

    An array is one value of one row, so a key must not own more rows than a task can hold;
    the pipelines keep their rows flat.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias(into))


def unnest(df: DataFrame, col: str) -> DataFrame:
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.inline(col))


def year_rows(df: DataFrame, first: Column, last: Column, into: str) -> DataFrame:
    """One row per year from ``first`` to ``last``."""
    return df.withColumn(into, F.explode(F.sequence(first, last)))


def variants(df: DataFrame, labelled: Mapping[str, Column], label: str, value: str) -> DataFrame:
    """Each row once per label, with that label's expression, in one pass."""
    pairs = [
        F.struct(F.lit(name).alias(label), expr.alias(value)) for name, expr in labelled.items()
    ]
    return df.select("*", F.inline(F.array(*pairs)))


# --- value domains -----------------------------------------------------------


def row_salt(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` from a row's columns and partition; the same on every run of a task."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(salts)).cast("int")


def expand_over(df: DataFrame, source: DataFrame, col: str) -> DataFrame:
    """Each row once per distinct value of ``source[col]``, added as column ``col``.

    An equi-join on a salt: rows are dealt to salts by a hash of their columns and partition, the
    distinct values appear once per salt.  Repeated rows share a salt only within a partition, so a
    salt holds no more of them than one task did.  The salts grow with the shuffle partitions, so the
    result is built by all tasks; a small domain is broadcast by adaptive execution.
    """
    salts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    domain = source.select(F.col(col).alias("__value")).distinct().withColumn("__salt", every)
    dealt = df.withColumn("__salt", row_salt(df, salts))
    return dealt.join(domain, "__salt").select(*df.columns, F.col("__value").alias(col))


def value_grid(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """All pairs of the distinct values of two columns."""
    return expand_over(left.select(left_col).distinct(), right, right_col)
