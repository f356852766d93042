"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def full_year(year: Column) -> Column:
    """Year text with 1, 2 or 4 digits to INT: 0-68 is 20xx, 69-99 is 19xx."""
    number = year.try_cast("int")
    century = F.when(F.length(year) > 2, 0).when(number <= 68, 2000).otherwise(1900)
    return F.when(year.rlike("^([0-9]{1,2}|[0-9]{4})$"), number + century)


def parse_ymd(year: Column, month: Column, day: Column) -> Column:
    """Date from text parts; NULL when a part is missing or the day does not exist.

    Each part is used once, so that the expression stays small where filters on the
    result are pushed down to the raw columns.
    """
    number = F.lpad(full_year(year).cast("string"), 4, "0")
    text = F.concat(number, F.lit("-"), month, F.lit("-"), day)
    return F.regexp_extract(text, ISO_DATE, 0).try_cast("date")


def next_boundary(day: Column, month: int = 7) -> Column:
    """First start of ``month`` strictly after ``day``: a row expression, no join.

    Moving the month to the end of the year makes the boundary the next January.
    """
    moved = F.trunc(F.add_months(day, 13 - month), "year")
    return F.add_months(moved, month - 1)


def months_before(day: Column, months: int | Column) -> Column:
    """Fixed shift for boundary dates, which always fall on a first of the month."""
    back = -months if isinstance(months, int) else F.negate(months)
    return F.add_months(day, back)


def strict_months_before(day: Column, months: Column) -> Column:
    """Month shift that is NULL when the target month has no such day."""
    moved = F.add_months(day, F.negate(months))
    return F.when(F.dayofmonth(moved) == F.dayofmonth(day), moved)


def shift_back(day: Column, amount: Column, unit: Column) -> Column:
    """``day`` minus an amount of ``days``, ``months`` or ``years``; other units give NULL."""
    months = F.when(unit == "months", amount).when(unit == "years", amount * 12)
    return F.when(unit == "days", F.date_sub(day, amount)).otherwise(
        strict_months_before(day, months)
    )
