"""Age split and overlapping bands."""

import math

from midyear.operators.bands import AGE_GROUPS, BANDS, BASE_GROUPS, band_rollup, split_age
from midyear.plans.vital import report_order, under_five

SHARES = [("0-27 days", 0.1), ("28 days-<3 month", 0.2), ("3-5 months", 0.25),
          ("6-8 months", 0.25), ("9-11 months", 0.2)]
POP = "year int, department string, municipality string, sex string, age int, population double"


def population(rows, *extra):
    data = [(2010, "Santa Rosa", "m", sex, age, 100.0 * (age + 1))
            for sex in ("male", "female") for age in range(6)]
    return rows(data + list(extra), POP)


def test_bridge_has_35_pairs():
    assert len(BASE_GROUPS) + sum(len(b) for b in BANDS.values()) == 35
    assert set(BANDS) | set(BASE_GROUPS) == set(AGE_GROUPS)


def test_bands_add_up(rows):
    shares = rows(SHARES, "age_group string, proportion double")
    got = {r.age_group: r.population for r in under_five(population(rows), shares).collect()}
    assert set(got) == set(AGE_GROUPS)
    assert math.isclose(got["0-11 months"], 200.0)
    assert math.isclose(got["0-59 months"], got["0-11 months"] + got["12-59 months"])
    assert math.isclose(got["0-5 months"] + got["6-11 months"], got["0-11 months"])
    assert math.isclose(got["24-59 months"], 600.0 + 800.0 + 1000.0)
    assert math.isclose(got["9-11 months"], 40.0)


def test_scope_and_null_poison(rows):
    shares = rows(SHARES, "age_group string, proportion double")
    extra = [(2010, "Peten", "m", "male", 1, 5.0), (2009, "Santa Rosa", "m", "male", 1, 5.0),
             (2011, "Santa Rosa", "m", "male", 1, None), (2011, "Santa Rosa", "m", "male", 2, 1.0)]
    out = under_five(population(rows, *extra), shares)
    got = {(r.year, r.age_group): r.population for r in out.collect()}
    assert {y for y, _ in got} == {2010, 2011}
    assert got[(2011, "12-23 months")] is None and got[(2011, "0-59 months")] is None
    assert got[(2011, "24-59 months")] == 1.0


def test_unlabelled_rows_count_in_the_whole_band_only(rows):
    df = rows([(1, None, 3.0), (1, "12-23 months", 2.0)], "k int, band string, v double")
    got = {r.band: r.v for r in band_rollup(df, "band", ["k"], "v").collect()}
    assert got == {None: 3.0, "12-23 months": 2.0, "12-59 months": 2.0, "0-59 months": 5.0}


def test_age_without_share_keeps_its_population(rows):
    pop = population(rows).filter("age <= 1")
    none = rows([], "age_group string, proportion double")
    got = {r.age_group: r.population for r in split_age(pop, none).collect()}
    assert got == {None: 200.0, "12-23 months": 400.0}
    bad = rows([("0-27 days", math.nan)], "age_group string, proportion double")
    got = {r.age_group: r.population for r in split_age(pop, bad).collect()}
    assert got == {"0-27 days": 200.0, "12-23 months": 400.0}


def test_report_order(rows):
    shares = rows(SHARES, "age_group string, proportion double")
    got = [r.age_group for r in report_order(under_five(population(rows), shares)).collect()]
    assert got == AGE_GROUPS
