"""Labels, births, deaths, shares and gates at calendar edges."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from midyear.operators import cohort
from midyear.operators.events import decode_births, infant_deaths
from midyear.operators.joins import stop_if_any
from midyear.plans.vital import check_uniform

D = dt.date
MID = D(2011, 7, 1)


def test_labels_at_their_bounds(rows):
    days = [D(2011, 6, 30), D(2011, 6, 3), D(2011, 6, 2), D(2011, 4, 1), D(2011, 3, 31),
            D(2011, 1, 1), D(2010, 12, 31), D(2010, 10, 1), D(2010, 9, 30), D(2010, 7, 1)]
    gone = [D(2011, 7, 1), D(2010, 6, 30), None]
    df = rows([(d, MID) for d in days + gone], "d date, mid_year date")
    got = {r.d: r.label for r in cohort.cohort_label(df, "d").collect()}
    assert got == dict(zip(days, [
        "0-27 days", "0-27 days", "28 days-<3 month", "28 days-<3 month", "3-5 months",
        "3-5 months", "6-8 months", "6-8 months", "9-11 months", "9-11 months"]))


def test_label_variants_and_youngest(rows):
    df = rows([(1, D(2011, 5, 1), MID)], "id int, d date, mid_year date")
    every = cohort.label_variants(df, "d")
    assert sorted(r.correlative for r in every.collect()) == [2, 3, 4, 5]
    assert [r.label for r in cohort.youngest_label(every, ["id"]).collect()] == [
        "28 days-<3 month"]


def test_mid_years_pairs(rows):
    df = rows([(D(2010, 1, 1),), (D(2012, 5, 5),), (None,)], "event_date date")
    got = sorted((r.mid_year.year, r.event_year) for r in cohort.mid_years(df).collect())
    assert got == [(2010, 2010), (2012, 2010), (2012, 2011), (2012, 2012)]


def births(rows, data):
    return rows(data, "event_date date, mother_department string, mother_municipality string")


PLACES = [("0601", "Cuilapa"), ("0902", "Salcaja")]


def test_births_at(rows):
    df = births(rows, [
        (D(2009, 6, 30), "6", "1"),       # before the first date
        (D(2009, 7, 1), "6", "1"),        # July 1 belongs to the next mid-year
        (D(2010, 6, 30), "6", "1"),
        (D(2010, 6, 30), "6", "0601"),    # number below 99 is padded, this one is not short
        (D(2010, 6, 30), "9", "902"),     # three digits match nothing
        (D(2010, 6, 30), "12", "1"),      # out of scope
        (D(2010, 7, 1), "6", "1"),        # no 2011 births: no mid-year 2011
        (None, "6", "1"),
    ])
    places = rows(PLACES, "muni_id string, municipality string")
    got = sorted(cohort.births_at(df, cohort.mid_years(df), places).collect(), key=str)
    assert [tuple(r) for r in got] == [
        (2010, "Quetzaltenango", None, "0-27 days", 1),
        (2010, "Santa Rosa", "Cuilapa", "0-27 days", 1),
        (2010, "Santa Rosa", "Cuilapa", "0-27 days", 1),
        (2010, "Santa Rosa", "Cuilapa", "9-11 months", 1),
    ]


def test_deaths_at(rows):
    deaths = rows([
        (2010, D(2010, 6, 1), "6", "0601", D(2010, 5, 30)),
        (2009, D(2009, 12, 1), "6", "0601", D(2009, 7, 1)),    # born exactly a year before
        (2009, D(2009, 12, 1), "6", "0601", D(2009, 7, 2)),
        (2010, D(2010, 6, 1), "6", "601", D(2010, 5, 30)),     # unpadded code
        (2010, D(2010, 6, 1), "6", "0601", None),
        (2010, D(2010, 8, 1), "6", "0601", D(2010, 7, 15)),    # mid-year 2011 has no births
        (2008, D(2008, 6, 1), "6", "0601", D(2008, 5, 1)),     # before the first birth year
    ], "event_year int, event_date date, event_department string, event_municipality string, "
       "birth_date date")
    years = cohort.mid_years(rows([(D(2009, 1, 1),), (D(2010, 1, 1),)], "event_date date"))
    places = rows(PLACES, "muni_id string, municipality string")
    got = sorted(cohort.deaths_at(deaths, years, places).collect(), key=str)
    assert [tuple(r) for r in got] == [
        (2010, "Santa Rosa", "Cuilapa", "28 days-<3 month", 1),
        (2010, "Santa Rosa", "Cuilapa", "9-11 months", 1),
        (2010, "Santa Rosa", None, "28 days-<3 month", 1),
    ]
    padded = cohort.deaths_at(deaths.withColumn("event_municipality", F.lit("1")), years, places,
                              normalise_codes=True)
    assert {r.municipality for r in padded.collect()} == {"Cuilapa"}


KEYED = "year int, department string, municipality string, age_group string, "


def test_survivor_share(rows):
    births = rows([(2010, "a", None, "x", 4), (2010, "a", None, "y", 6), (2011, "a", "m", "x", 2)],
                  KEYED + "births bigint")
    deaths = rows([(2010, "a", None, "x", 1), (2011, "a", "m", "x", 2)], KEYED + "deaths bigint")
    got = {(r.year, r.age_group): (r.deaths, r.alive, r.proportion)
           for r in cohort.survivor_share(births, deaths).collect()}
    assert got[(2010, "x")] == (1, 3, 3 / 9) and got[(2010, "y")] == (0, 6, 6 / 9)
    assert got[(2011, "x")][:2] == (2, 0) and math.isnan(got[(2011, "x")][2])


def test_means_keep_nan_and_skip_nothing(rows):
    shares = rows([(2010, "d", "x", 0.5), (2011, "d", "x", 0.7), (2011, "d", "y", math.nan)],
                  "year int, department string, age_group string, proportion double")
    got = {r.age_group: r.proportion for r in cohort.mean_share(shares).collect()}
    assert abs(got["x"] - 0.6) < 1e-12 and math.isnan(got["y"])
    assert cohort.trend_share(shares).count() == 3


def test_uniform_gate_is_one_sided(rows):
    uniform = [(k, v / 12) for k, v in cohort.INFANT_MONTHS.items()]
    low = [("3-5 months", 0.1), ("0-27 days", 1 / 12 + 0.009)]
    schema = "age_group string, proportion double"
    check_uniform(rows(uniform + low, schema))
    with pytest.raises(ValueError):
        check_uniform(rows([("0-27 days", 1 / 12 + 0.011)], schema))


def test_stop_if_any(rows):
    stop_if_any(rows([], "a int"), "empty")
    with pytest.raises(ValueError, match="two"):
        stop_if_any(rows([(1,), (2,)], "a int"), "two")


def raw_deaths(rows, data):
    schema = ("file_year string, anoocu string, mesocu string, diaocu string, perdif string, "
              "edadif string, depreg string, mupreg string")
    return rows(data, schema)


def test_infant_deaths(rows):
    df = raw_deaths(rows, [
        ("2010", None, "3", "31", "2", "1", "6", "601"),   # no 31 February
        ("2010", "10", "3", "1", "1", "5", "9", "902"),
        ("2010", "10", "3", "1", "3", "5", "9", "902"),    # years
        ("2010", "10", "3", "1", "9", "5", "9", "902"),    # unknown unit
        ("2010", "10", "3", "1", "1", "999", "9", "902"),  # unknown age
        ("2010", "10", "3", "1", None, "5", "9", "902"),
        ("2010", "10", "3", "1", "1", "5", "12", "902"),   # out of scope
    ])
    got = sorted((r.event_date, r.age_unit, r.birth_date) for r in infant_deaths(df).collect())
    assert got == [(D(2010, 3, 1), "days", D(2010, 2, 24)), (D(2010, 3, 31), "months", None)]


def test_decode_births_has_16_columns(spark):
    names = ("file_year anoreg mesreg anoocu mesocu diaocu libras onzas sexo tipar viapar pueblopm "
             "pueblopp depocu mupocu depreg mupreg deprem muprem edadm").split()
    row = ["2010", "10", "7", None, "2", "30", "6", "0", "3", "1", "2", "9", "2"] + ["1"] * 7
    got = decode_births(spark.createDataFrame([row], ", ".join(f"{n} string" for n in names)))
    r = got.first()
    assert len(got.columns) == 16 and r.event_date is None and r.record_date == D(2010, 7, 1)
    assert (r.sex, r.birth_type, r.delivery_type, r.mother_group, r.father_group) == (
        "3", "simple", "Vaginal", "Ignored", "Garífuna")
