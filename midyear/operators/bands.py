"""Splitting age 0 by shares and rolling up to overlapping age bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.numbers import known
from midyear.functions.recode import in_domain, recode
from midyear.operators.totals import group_sum

# Age groups in output order.
AGE_GROUPS = [
    "0-27 days", "28 days-<3 month", "3-5 months", "6-8 months", "9-11 months",
    "0-11 months",
    "12-23 months", "24-35 months", "36-47 months", "48-59 months",
    "0-5 months", "6-11 months",
    "0-59 months",
    "12-59 months", "24-59 months",
]
INFANT_GROUPS = AGE_GROUPS[:5]
YEAR_GROUPS = AGE_GROUPS[6:10]
BASE_GROUPS = INFANT_GROUPS + YEAR_GROUPS
# Single years of age and the group each one is.
AGE_TO_GROUP = dict(zip([1, 2, 3, 4], YEAR_GROUPS))

# Fixed value: the band that takes every row, also one without an age group.
WHOLE_BAND = "0-59 months"
# Derived bands and their base groups.
BANDS = {
    "0-11 months": INFANT_GROUPS,
    "0-59 months": BASE_GROUPS,
    "12-59 months": YEAR_GROUPS,
    "24-59 months": YEAR_GROUPS[1:],
    "0-5 months": INFANT_GROUPS[:3],
    "6-11 months": INFANT_GROUPS[3:],
}


def bands_of(base: Column, bands: Mapping[str, Sequence[str]],
             whole: str | None = None) -> Column:
    """The base group itself followed by every band that contains it.

    Rows outside every band, NULL included, belong to themselves and to ``whole``.
    """
    members: dict[str, list[str]] = {}
    for band, bases in bands.items():
        for b in bases:
            members.setdefault(b, []).append(band)
    by_base: Column | None = None
    for b, names in members.items():
        test, array = base == F.lit(b), F.array(F.lit(b), *[F.lit(n) for n in names])
        by_base = F.when(test, array) if by_base is None else by_base.when(test, array)
    alone = F.array(base) if whole is None else F.array(base, F.lit(whole))
    return alone if by_base is None else by_base.otherwise(alone)


def band_rollup(df: DataFrame, band: str, keys: Sequence[str], value: str,
                bands: Mapping[str, Sequence[str]] = BANDS,
                whole: str | None = WHOLE_BAND) -> DataFrame:
    """Totals of base groups and of the overlapping bands built from them.

    Rows are summed per base group first, so only these totals are copied into bands.
    Every band holds all rows of its bases; a band with no rows is absent.
    """
    base = group_sum(df, [*keys, band], value)
    copied = base.withColumn(band, F.explode(bands_of(F.col(band), bands, whole)))
    return group_sum(copied, [*keys, band], value)


def split_age(
    population: DataFrame,
    shares: DataFrame,
    keys: Sequence[str] = ("year", "department", "municipality"),
    age: int = 0,
    labels: Mapping[int, str] = AGE_TO_GROUP,
    levels: Sequence[str] = AGE_GROUPS,
) -> DataFrame:
    """Population per age group, with one age split by the shares of its sub-groups.

    ``shares`` holds one row per label.  Reduced to the fixed list ``levels``, with a label
    that occurs twice as an error, it has no more rows than that list and is broadcast.  An
    age without shares keeps its whole population.
    """
    totals = group_sum(population, [*keys, "age"], "population")
    twice = F.raise_error(F.concat(F.lit("two shares for "), "age_group")).cast("double")
    bounded = shares.filter(F.col("age_group").isin(list(levels))).groupBy("age_group").agg(
        F.when(F.count(F.lit(1)) == 1, F.first("proportion")).otherwise(twice).alias("proportion")
    ).withColumn("__age", F.lit(age))
    split = totals.join(F.broadcast(bounded), F.col("age") == F.col("__age"), "left")
    part = (F.col("age") == age) & known(F.col("proportion"))
    return split.select(
        *keys,
        in_domain(recode(F.col("age"), labels, default=F.col("age_group")), levels).alias(
            "age_group"),
        F.when(part, F.col("population") * F.col("proportion"))
        .otherwise(F.col("population")).alias("population"),
    )
