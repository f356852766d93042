"""Births and deaths to infant shares, and under-five population by age band."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from midyear.functions.recode import ordinal, recode
from midyear.functions.text import title_case, to_ascii
from midyear.operators.bands import AGE_GROUPS, band_rollup, split_age
from midyear.operators.cohort import (
    DEPARTMENTS, FIRST_DATE, PLACE_KEYS, births_at, daily_births, deaths_at, exceeds_uniform, mean_share,
    mid_years, survivor_share, uniform_violations,
)
from midyear.operators.events import decode_births, infant_deaths
from midyear.operators.joins import stop_if_any, written_if_none
from midyear.sources.scans import place_lookup
from midyear.sources.shared import cut_lineage

# Place names by code.
NAMES_BY_CODE = {
    "0413": "San Andres Itzapa",
    "2009": "Quezaltepeque",
    "0204": "San Cristobal Acasaguastlan",
    "0502": "Santa Lucia Cotzumalguapa",
    "0506": "Tiquizate",
    "0117": "San Miguel Petapa",
    "0111": "San Raimundo",
    "1314": "San Rafael La Independencia",
    "1320": "San Sebastian Huehuetenango",
    "1326": "Santa Cruz Barillas",
    "2107": "Mataquescuintla",
    "2217": "Quezada",
    "1420": "Ixcan",
    "1105": "San Felipe",
    "0712": "San Antonio Palopo",
    "0711": "Santa Catarina Palopo",
    "1004": "San Bernardino",
    "1009": "San Pablo Jocopilas",
    "1011": "San Miguel Panan",
    "0806": "Santa Maria Chiquimula",
}
# Years and ages of the report.
FIRST_YEAR, LAST_YEAR = 2010, 2017
FIRST_AGE, LAST_AGE = 0, 4
NOT_UNIFORM = "shares deviate from the uniform assumption"


def place_names(df: DataFrame, code: str, name: str,
                overrides: Mapping[str, str] = NAMES_BY_CODE) -> DataFrame:
    """Place lookup with ASCII title-cased names and overrides by code."""
    places = place_lookup(df, code, name)
    clean = title_case(to_ascii(F.col("municipality")))
    return places.withColumn(
        "municipality", recode(F.col("muni_id"), overrides, default=clean)
    )


def infant_shares(
    raw_births: DataFrame,
    raw_deaths: DataFrame,
    places: DataFrame,
    departments: Mapping[str, str] = DEPARTMENTS,
    first_date: str = FIRST_DATE,
    normalise_codes: bool = False,
) -> DataFrame:
    """Survivors and their share per place, mid-year and infant age group.

    The raw births are read and decoded once: their daily counts are written to the shared
    folder (runs a job), and both the mid-years and the cohorts come from them.
    """
    daily = cut_lineage(daily_births(decode_births(raw_births)))
    years = mid_years(daily)
    born = births_at(daily, years, places, departments, first_date, weight="n")
    died = deaths_at(infant_deaths(raw_deaths, tuple(departments)), years, places, departments,
                     normalise_codes)
    return survivor_share(born, died)


def check_uniform(shares: DataFrame) -> None:
    """Stop when a mean share lies too far above the uniform one (runs a job)."""
    stop_if_any(uniform_violations(shares), NOT_UNIFORM)


def under_five(
    population: DataFrame,
    shares: DataFrame,
    departments: Mapping[str, str] = DEPARTMENTS,
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
) -> DataFrame:
    """Population per place, year and age band below five years."""
    scope = population.filter(
        F.col("year").between(*years)
        & F.col("age").between(FIRST_AGE, LAST_AGE)
        & F.col("department").isin(list(departments.values()))
    )
    split = split_age(scope, shares, PLACE_KEYS)
    bands = band_rollup(split, "age_group", PLACE_KEYS, "population")
    return bands.select("department", "municipality", "year", "age_group", "population")


def vital_table(
    raw_births: DataFrame,
    raw_deaths: DataFrame,
    places: DataFrame,
    population: DataFrame,
    departments: Mapping[str, str] = DEPARTMENTS,
    first_date: str = FIRST_DATE,
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
    check: bool = True,
) -> DataFrame:
    """Under-five report from raw records and the population table.

    The mean shares are written to the shared folder; the check counts as they are written.
    """
    shares = mean_share(infant_shares(raw_births, raw_deaths, places, departments, first_date))
    violation = exceeds_uniform() if check else F.lit(False)
    shares = written_if_none(shares, violation, NOT_UNIFORM)
    return under_five(population, shares, departments, years)


def report_order(df: DataFrame) -> DataFrame:
    """Sort by place, year and age group in output order."""
    return df.orderBy("department", "municipality", "year",
                      ordinal(F.col("age_group"), AGE_GROUPS))
