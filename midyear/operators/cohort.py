"""Mid-year cohorts: boundaries, age labels, births, deaths and survivors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.dates import months_before, next_boundary, shift_back
from midyear.functions.numbers import safe_int
from midyear.functions.recode import ordinal, recode
from midyear.functions.text import pad_left
from midyear.operators.joins import code_lookup, join_on
from midyear.operators.shape import derive_once, variants
from midyear.operators.totals import group_mean, keep_group_min, share_of_total
from midyear.sources.shared import cut_lineage

# Infant age groups, youngest first, with the age in days or months before
# the boundary at which each one begins, and its length in months.
INFANT_THRESHOLDS = [
    ("0-27 days", "days", 28),
    ("28 days-<3 month", "months", 3),
    ("3-5 months", "months", 6),
    ("6-8 months", "months", 9),
    ("9-11 months", "months", 12),
]
INFANT_MONTHS = {
    "0-27 days": 1,
    "28 days-<3 month": 2,
    "3-5 months": 3,
    "6-8 months": 3,
    "9-11 months": 3,
}

# First usable date, departments in scope and their names.
FIRST_DATE = "2009-07-01"
DEPARTMENTS = {"6": "Santa Rosa", "9": "Quetzaltenango"}

PLACE_KEYS = ["year", "department", "municipality"]


def threshold_date(boundary: Column, unit: str, amount: int) -> Column:
    return F.date_sub(boundary, amount) if unit == "days" else months_before(boundary, amount)


def age_label(day: Column, boundary: Column, thresholds=INFANT_THRESHOLDS) -> Column:
    """Youngest group whose lower bound is on or before ``day``; NULL before the oldest."""
    label, unit, amount = thresholds[0]
    out = F.when(day >= threshold_date(boundary, unit, amount), F.lit(label))
    for label, unit, amount in thresholds[1:]:
        out = out.when(day >= threshold_date(boundary, unit, amount), F.lit(label))
    return out


def cohort_label(df: DataFrame, date: str, boundary: str = "mid_year",
                 label: str = "label", thresholds=INFANT_THRESHOLDS) -> DataFrame:
    """Label each date with its age group at its boundary.

    Dates from the boundary on, or before the oldest group, are dropped.  The filter is a
    plain date range, which stays small when it is pushed down to a derived date.
    """
    day, end = F.col(date), F.col(boundary)
    _, unit, amount = thresholds[-1]
    kept = df.filter((day < end) & (day >= threshold_date(end, unit, amount)))
    return kept.withColumn(label, age_label(day, end, thresholds))


def label_variants(df: DataFrame, date: str, boundary: str = "mid_year",
                   thresholds=INFANT_THRESHOLDS) -> DataFrame:
    """Each row once per group it is old enough for (``correlative`` 1 is the youngest)."""
    lower = {
        label: threshold_date(F.col(boundary), unit, amount)
        for label, unit, amount in thresholds
    }
    rows = variants(df, lower, "label", "date_threshold")
    rows = rows.filter(F.col(date) >= F.col("date_threshold")).drop("date_threshold")
    return rows.withColumn("correlative", ordinal(F.col("label"), list(lower)))


def youngest_label(labelled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the youngest group of each key, ties included."""
    return keep_group_min(labelled, keys, "correlative")


def mid_years(births: DataFrame, date: str = "event_date") -> DataFrame:
    """``(mid_year, event_year)``: each July 1 of a year with births, paired with every year
    from the first birth year on.  Rows with no date are ignored.

    The births are read once, into one set of calendar years; the range of DATE bounds it
    to 9,999 values.
    """
    found = births.agg(F.collect_set(F.year(date)).alias("ys"))
    years = found.select(F.explode("ys").alias("y"), F.array_min("ys").alias("first"))
    return years.select(
        F.make_date(F.col("y"), F.lit(7), F.lit(1)).alias("mid_year"),
        F.explode(F.sequence("first", "y")).alias("event_year"),
    )


def at_mid_year(events: DataFrame, years: DataFrame, date: str,
                event_year: Column | None = None) -> DataFrame:
    """Each event with the one mid-year that follows it, if ``years`` pairs the two.

    ``years`` is reduced to one row per calendar year that has a mid-year, which the range
    of DATE bounds to 9,999 rows, so it is broadcast.
    """
    year = F.year(date) if event_year is None else event_year
    tagged = events.withColumns({"mid_year": next_boundary(F.col(date)), "__year": year})
    known_years = years.groupBy(F.col("mid_year").alias("__b")).agg(
        F.min("event_year").alias("__from"), F.max("event_year").alias("__to")
    )
    found = (F.col("mid_year") == F.col("__b")) & F.col("__year").between(
        F.col("__from"), F.col("__to"))
    return tagged.join(F.broadcast(known_years), found, "left_semi").drop("__year")


def births_at(
    births: DataFrame,
    years: DataFrame,
    places: DataFrame,
    departments: Mapping[str, str] = DEPARTMENTS,
    first_date: str = FIRST_DATE,
    department: str = "mother_department",
    municipality: str = "mother_municipality",
    weight: str | None = None,
) -> DataFrame:
    """Live births per place and age group at each mid-year.

    One scan, one shuffle of partial counts: the label depends on the row alone, and the
    scope and date filters are applied before anything is grouped.  ``weight`` names the
    count column when ``births`` is a table of daily counts.
    """
    first = F.lit(first_date).cast("date")
    rows = births.filter(
        F.col(department).isin(list(departments)) & (F.col("event_date") >= first)
    ).select(
        F.col(department).alias("department"),
        F.col(municipality).alias("muni_id"),
        "event_date",
        (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("n"),
    )
    # The boundary follows the event, so it is past the first date and less than twelve
    # months away: every row left has a label.
    rows = at_mid_year(rows, years, "event_date").withColumn(
        "age_group", age_label(F.col("event_date"), F.col("mid_year")))
    counts = rows.groupBy(
        F.year("mid_year").alias("year"), "department", "muni_id", "age_group"
    ).agg(F.sum("n").alias("births"))
    counts = counts.withColumn(
        "muni_id", place_code(F.col("department"), F.col("muni_id"))
    ).withColumn("department", recode(F.col("department"), departments))
    return code_lookup(counts, places, "muni_id").select(*PLACE_KEYS, "age_group", "births")


def place_code(department: Column, municipality: Column) -> Column:
    """Two-digit department and place when the place number is short, else as it is."""
    joined = F.concat(pad_left(department), pad_left(municipality))
    number = safe_int(municipality)
    return F.when(number < 99, joined).when(number >= 99, municipality)


def daily_births(births: DataFrame, department: str = "mother_department",
                 municipality: str = "mother_municipality") -> DataFrame:
    """Births per place and day (``n``): at most one row per place and calendar day."""
    return births.groupBy(department, municipality, "event_date").agg(
        F.count(F.lit(1)).alias("n"))


def with_birth_date(deaths: DataFrame, date: str = "event_date", value: str = "age_value",
                    unit: str = "age_unit") -> DataFrame:
    """Birth date from the age at death; NULL where that day does not exist."""
    birth = shift_back(F.col(date), F.col(value), F.col(unit))
    return derive_once(deaths, birth_date=birth)


def deaths_at(
    deaths: DataFrame,
    years: DataFrame,
    places: DataFrame,
    departments: Mapping[str, str] = DEPARTMENTS,
    normalise_codes: bool = False,
) -> DataFrame:
    """Infant deaths per place and age group at the mid-year they did not reach.

    ``normalise_codes`` pads place codes like those of births before the lookup.
    """
    rows = at_mid_year(deaths, years, "event_date", F.col("event_year"))
    rows = rows.filter(F.col("birth_date") > months_before(F.col("mid_year"), 12))
    rows = rows.withColumn("age_group", age_label(F.col("birth_date"), F.col("mid_year")))
    counts = rows.groupBy(
        F.year("mid_year").alias("year"),
        F.col("event_department").alias("department"),
        F.col("event_municipality").alias("muni_id"),
        "age_group",
    ).agg(F.count(F.lit(1)).alias("n"))
    if normalise_codes:
        counts = counts.withColumn("muni_id",
                                   place_code(F.col("department"), F.col("muni_id")))
    counts = code_lookup(counts, places, "muni_id").withColumn(
        "department", recode(F.col("department"), departments)
    )
    return counts.groupBy(*PLACE_KEYS, "age_group").agg(F.sum("n").alias("deaths"))


def survivor_share(births: DataFrame, deaths: DataFrame,
                   keys: Sequence[str] = tuple(PLACE_KEYS),
                   label: str = "age_group") -> DataFrame:
    """Births minus deaths per label (no deaths row means 0) and the share within ``keys``.

    The counts are written once (runs a job): rows and totals are both read from them.
    """
    joined = join_on(births, deaths, [*keys, label], "left")
    alive = joined.withColumn("deaths", F.coalesce("deaths", F.lit(0))).withColumn(
        "alive", F.col("births") - F.col("deaths")
    )
    return share_of_total(cut_lineage(alive), keys, "alive")


def mean_share(shares: DataFrame) -> DataFrame:
    """Unweighted mean share per age group."""
    return group_mean(shares, ["age_group"], "proportion")


def trend_share(shares: DataFrame) -> DataFrame:
    """Mean share per year, department and age group."""
    return group_mean(shares, ["year", "department", "age_group"], "proportion")


def uniform_violations(shares: DataFrame, months: Mapping[str, int] = INFANT_MONTHS,
                       tolerance: float = 0.01) -> DataFrame:
    """Age groups whose mean share exceeds the uniform share by more than ``tolerance``.

    Only excess counts; a share below the uniform one passes.
    """
    uniform = _uniform(months)
    return (
        shares.withColumn("uniform_proportion", uniform)
        .withColumn("deviation", F.col("proportion") - F.col("uniform_proportion"))
        .filter((F.col("deviation") > tolerance) & ~F.isnan("deviation"))
    )


def exceeds_uniform(months: Mapping[str, int] = INFANT_MONTHS, tolerance: float = 0.01) -> Column:
    """Whether a row's mean share is one of ``uniform_violations``."""
    deviation = F.col("proportion") - _uniform(months)
    return (deviation > tolerance) & ~F.isnan(deviation)


def _uniform(months: Mapping[str, int]) -> Column:
    return recode(F.col("age_group"), months, default=F.lit(None).cast("int")) / F.lit(12.0)


