"""Joins whose keys match NULL with NULL.

No join here carries a broadcast hint for a table that can grow: Spark broadcasts a
side it has measured to be small (file statistics, or shuffle statistics under
adaptive execution) and otherwise sort-merges, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from midyear.functions.recode import recode
from midyear.operators.shape import row_salt
from midyear.sources.shared import cut_lineage


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str],
            how: str = "left", null_salts: int = 1) -> DataFrame:
    """Null-safe equi-join; ``on`` lists shared columns or maps left to right names.

    The key columns of the right side are dropped from the result.  ``null_salts`` above 1 deals left rows
    with a NULL among their keys, which would all meet in one task, over that many salts, and repeats the
    right rows of such keys for each: for right sides with few of them (one a key, say).
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    if null_salts > 1:
        if how not in ("left", "inner", "left_semi", "left_anti"):
            raise ValueError(f"a {how} join would repeat right rows")
        some_null = lambda names: reduce(or_, [F.col(f"`{c}`").isNull() for c in names])
        salt = F.when(some_null(pairs), row_salt(left, null_salts)).otherwise(0)
        every = F.when(some_null(pairs.values()), F.sequence(F.lit(0), F.lit(null_salts - 1))).otherwise(F.array(F.lit(0)))
        out = join_on(left.withColumn("__salt", salt), right.withColumn("__salt_r", F.explode(every)),
                      pairs | {"__salt": "__salt_r"}, how)
        return out.drop("__salt")
    renamed = {r: f"__right_{i}" for i, r in enumerate(pairs.values())}
    keyed = right.toDF(*[renamed.get(c, c) for c in right.columns])
    condition = F.expr(" AND ".join(f"`{a}` <=> `{renamed[b]}`" for a, b in pairs.items()))
    joined = left.join(keyed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every column name the two tables share."""
    shared = [c for c in left.columns if c in set(right.columns)]
    return join_on(left, right, shared, "left")


def code_lookup(facts: DataFrame, places: DataFrame, code: str,
                places_code: str = "muni_id") -> DataFrame:
    """Code to name; unmatched codes keep NULL attributes.  A plain equi-join, as a NULL
    code has no name."""
    right = places.withColumnRenamed(places_code, "__code")
    return facts.join(right, facts[code] == F.col("__code"), "left").drop("__code")


def override_by_code(df: DataFrame, code: str, target: str, overrides: Mapping) -> DataFrame:
    """Replace ``target`` where ``code`` is listed."""
    return df.withColumn(target, recode(F.col(code), overrides, default=F.col(target)))


def one_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` and ``value`` with one row per key; a key with two different values fails."""
    text = F.concat(F.lit("two values for "), F.to_json(F.struct(*keys)))
    kind = df.schema[value].dataType
    # structs also count a NULL value as a value of its own
    found = df.groupBy(*keys).agg(
        F.min(F.struct(value)).alias("__low"), F.max(F.struct(value)).alias("__high"))
    same = F.col("__low") == F.col("__high")
    return found.select(*keys, F.when(same, F.col(f"__low.{value}")).otherwise(
        F.raise_error(text).cast(kind)).alias(value))


def override_from_table(df: DataFrame, overrides: DataFrame, on: Sequence[str] | Mapping,
                        target: str, replacement: str = "replacement") -> DataFrame:
    """Replace ``target`` from an override table; a key with two replacements fails."""
    keys = list(on.values()) if isinstance(on, Mapping) else list(on)
    joined = join_on(df, one_per_key(overrides, keys, replacement), on, "left")
    changed = joined.withColumn(target, F.coalesce(F.col(replacement), F.col(target)))
    return changed.select(*df.columns)


def override_within(c: Column, scope: Column, overrides: Mapping) -> Column:
    """Value map that applies only where ``scope`` holds; a NULL scope gives NULL."""
    return F.when(scope, recode(c, overrides)).when(~scope, c)


def override_pairs(c: Column, scope: Column, overrides: Mapping) -> Column:
    """Value map of pairs: a value is replaced where ``scope`` holds too.  A NULL scope leaves
    values that no pair names, and makes the others NULL."""
    named = c.isin(list(overrides)) if overrides else F.lit(False)
    return F.when(~named, c).when(scope, recode(c, overrides)).when(~scope, c)


def unknown_names(df: DataFrame, reference: DataFrame, col: str,
                  group: Sequence[str]) -> DataFrame:
    """Groups whose ``col`` never occurs in ``reference``, with their row counts ``n``.

    Both sides are reduced to distinct values before the join, so no key is hot.
    """
    tallied = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return join_on(tallied, reference.select(col).distinct(), [col], "left_anti")


def written_if_none(df: DataFrame, violation: Column, message: str) -> DataFrame:
    """``df`` written once to the shared folder; raises when ``violation`` held in any row.

    The rows are counted as they are written, so the gate scans nothing by itself.
    """
    watch = Observation()
    out = cut_lineage(df.observe(watch, F.count_if(F.coalesce(violation, F.lit(False))).alias("n")))
    if watch.get["n"] > 0:
        raise ValueError(message)
    return out


def stop_if_any(violations: DataFrame, message: str) -> None:
    """Raise when a violations table has rows (runs a job that stops at the first row)."""
    if violations.limit(1).count() > 0:
        raise ValueError(message)
