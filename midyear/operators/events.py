"""Decoding of coded birth and death records (all raw columns are text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.dates import parse_ymd
from midyear.functions.numbers import kilograms, safe_int
from midyear.functions.recode import recode, recode_known
from midyear.operators.cohort import DEPARTMENTS, with_birth_date
from midyear.operators.shape import derive_once

# Code tables of the record files.
SEX = {"1": "male", "2": "female"}
BIRTH_TYPE = {"1": "simple", "2": "double", "3": "triple", "4": "multiple"}
DELIVERY = {"1": "Cesarean", "2": "Vaginal"}
GROUP = {
    "1": "Maya",
    "2": "Garífuna",
    "3": "Xinka",
    "4": "Mestizo / Ladino",
    "5": "Other",
    "9": "Ignored",
}
ASSISTANCE = {
    "1": "Medic",
    "2": "Paramedic",
    "3": "Midwife",
    "4": "Empiric",
    "5": "None",
    "9": "Ignored",
}
DEATH_SITE = {
    "1": "Hospital, public",
    "2": "Hospital, private",
    "3": "Health center",
    "4": "Social security",
    "5": "Public way",
    "6": "Household",
    "7": "Place of work",
    "8": "Other",
    "9": "Ignored",
}
CERTIFIER = {"1": "Medic", "2": "Paramedic", "3": "Authority", "9": "Ignored"}
AGE_UNIT = {"1": "days", "2": "months", "3": "years"}
UNKNOWN_AGE = 999
UNKNOWN_UNIT = "9"
INFANT_UNITS = ["1", "2"]
REPAIRED_YEARS = {"9": 2009, "10": 2010}


def record_date() -> Column:
    """First day of the registration month."""
    return parse_ymd(F.col("anoreg"), F.col("mesreg"), F.lit("01"))


def event_date() -> Column:
    """Date of the event; a missing year is the year of the file."""
    return parse_ymd(F.coalesce("anoocu", "file_year"), F.col("mesocu"), F.col("diaocu"))


def repaired_year(event_year: Column, record_year: Column) -> Column:
    """Year of death: the register year, as it is, when missing; two short codes repaired."""
    missing = event_year.isNull() & record_year.isNotNull()
    out = F.when(missing, safe_int(record_year))
    for code, year in REPAIRED_YEARS.items():
        out = out.when(event_year == code, F.lit(year))
    return out.otherwise(safe_int(event_year))


def decode_births(raw: DataFrame) -> DataFrame:
    """Birth events, 16 columns."""
    return derive_once(raw, event_date=event_date()).select(
        F.year("event_date").alias("event_year"),
        "event_date",
        F.col("depocu").alias("event_department"),
        F.col("mupocu").alias("event_municipality"),
        record_date().alias("record_date"),
        F.col("depreg").alias("record_department"),
        F.col("mupreg").alias("record_municipality"),
        recode(F.col("sexo"), SEX).alias("sex"),
        kilograms(F.col("libras"), F.col("onzas")).alias("weight_kg"),
        recode(F.col("tipar"), BIRTH_TYPE).alias("birth_type"),
        recode(F.col("viapar"), DELIVERY).alias("delivery_type"),
        F.col("deprem").alias("mother_department"),
        F.col("muprem").alias("mother_municipality"),
        F.col("edadm").alias("mother_age"),
        recode(F.col("pueblopm"), GROUP).alias("mother_group"),
        recode(F.col("pueblopp"), GROUP).alias("father_group"),
    )


def decode_deaths(raw: DataFrame) -> DataFrame:
    """Death details, 15 columns."""
    year = repaired_year(F.col("anoocu"), F.col("anoreg"))
    date = parse_ymd(F.col("death_year").cast("string"), F.col("mesocu"), F.col("diaocu"))
    return raw.withColumn("death_year", year).select(
        "death_year",
        date.alias("death_date"),
        recode(F.col("sexo"), SEX).alias("sex"),
        safe_int(F.col("edadif")).alias("age_value"),
        recode_known(F.col("perdif"), AGE_UNIT).alias("age_unit"),
        F.col("dnadif").alias("death_department"),
        F.col("mnadif").alias("death_municipality"),
        F.col("dredif").alias("dept_resid"),
        F.col("mredif").alias("muni_resid"),
        recode(F.col("puedif"), GROUP).alias("cult_group"),
        F.col("caudef").alias("cause_icd10"),
        F.col("`caudef.descrip`").alias("cause_description"),
        recode(F.col("asist"), ASSISTANCE).alias("assistance_type"),
        recode(F.col("ocur"), DEATH_SITE).alias("death_site"),
        recode(F.col("cerdef"), CERTIFIER).alias("certified_death"),
    )


def infant_deaths(raw: DataFrame, departments: Sequence[str] = tuple(DEPARTMENTS)) -> DataFrame:
    """Deaths under one year registered in scope, with the derived birth date, 7 columns.

    Filtered on the raw codes first, so dates are only built for the rows kept.
    """
    kept = raw.filter(
        (safe_int(F.col("edadif")) < UNKNOWN_AGE)
        & (F.col("perdif") != UNKNOWN_UNIT)
        & F.col("perdif").isin(INFANT_UNITS)
        & F.col("depreg").isin(list(departments))
    )
    events = derive_once(
        kept,
        event_date=event_date(),
        age_value=safe_int(F.col("edadif")),
        age_unit=recode_known(F.col("perdif"), AGE_UNIT),
    ).select(
        F.year("event_date").alias("event_year"),
        "event_date",
        F.col("depreg").alias("event_department"),
        F.col("mupreg").alias("event_municipality"),
        "age_value",
        "age_unit",
    )
    return with_birth_date(events).select(
        "event_year", "event_date", "event_department", "event_municipality",
        "age_value", "age_unit", "birth_date",
    )
