"""Number expressions with explicit null and zero rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text accepted as a number; Java would also take suffixes such as "5d".
NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def safe_double(c: Column) -> Column:
    """Text to DOUBLE, bad text to NULL."""
    return F.when(c.rlike(NUMERIC), c.try_cast("double"))


def safe_int(c: Column) -> Column:
    """Text to INT by truncation ("5.7" is 5), bad or too large text to NULL."""
    return safe_double(c).try_cast("int")


#: Digits of 28 bits in which doubles are added up: multiples of 2 ** -112, below 2 ** 146.
_BITS, _DIGITS = 28, range(-4, 4)


def exact_sum(c: Column) -> Column:
    """Aggregate sum of doubles that does not depend on the order of rows or partitions.

    Every value is cut into signed digits of 28 bits at fixed places; digits are summed as whole numbers
    (2 ** 35 rows of a group at least) and put together at the end, the lowest first.  Bits below
    2 ** -112 are left out.  NaN and infinities give what they give in any order.
    """
    number = F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
    at = {k: F.rint(number * F.lit(2.0 ** (-_BITS * k))) for k in _DIGITS}
    total = F.lit(0.0)
    for k in _DIGITS:
        digit = at[k] - at[k + 1] * F.lit(2.0**_BITS) if k + 1 in at else at[k]
        total = total + F.sum(digit.cast("bigint")).cast("double") * F.lit(2.0 ** (_BITS * k))
    return F.coalesce(F.sum(F.when(F.isnan(c) | (F.abs(c) == float("inf")), c)), total)


def sum_of(df: DataFrame, value: str) -> Column:
    """The sum of a column: exact for doubles, Spark's own for whole numbers and decimals."""
    kind = df.schema[value].dataType.typeName()
    c = F.col(f"`{value}`")
    return exact_sum(c.cast("double")) if kind in ("double", "float") else F.sum(c)


def strict_sum(c: Column, total: Column | None = None) -> Column:
    """Aggregate sum that is NULL as soon as one value is NULL; ``total`` is the sum where it is not Spark's."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c) if total is None else total)


def share(part: Column, total: Column) -> Column:
    """``part / total`` in IEEE terms: 0/0 is NaN, x/0 is infinite, NULL stays NULL."""
    x = part.cast("double")
    by_zero = (
        F.when(F.isnan(x) | (x == 0), F.lit(float("nan")))
        .when(x > 0, F.lit(float("inf")))
        .when(x < 0, F.lit(float("-inf")))
    )
    return F.when(total == 0, by_zero).otherwise(x / total)


def known(c: Column) -> Column:
    """Neither NULL nor NaN."""
    return c.isNotNull() & ~F.isnan(c)


def kilograms(pounds: Column, ounces: Column, unknown: str = "99") -> Column:
    """Text pounds and ounces to kilograms; the code ``unknown`` in either gives NULL."""
    unknown_part = F.coalesce(pounds == unknown, F.lit(False)) | F.coalesce(
        ounces == unknown, F.lit(False)
    )
    return F.when(
        ~unknown_part, (safe_double(pounds) + safe_double(ounces) / 16) / 2.20462
    )
