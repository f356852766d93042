"""Grouped logit against an independent numpy fit; disaggregation properties."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from midyear.catalog import ORACLES, QUERIES
from midyear.operators import model
from oracle import compare

SCHEMA = "place string, year int, age int, population double"


def numpy_fit(data):
    """Plain reweighted least squares on the given rows (no grouping, no centring trick)."""
    totals = {}
    for y, _, p in data:
        totals[y] = totals.get(y, 0) + p
    x = np.array([[1.0, y - 2000.0, a] for y, a, _ in data])
    n = np.array([totals[y] for y, _, _ in data])
    p = np.array([v for _, _, v in data]) / n
    mu = (n * p + 0.5) / (n + 1)
    eta = np.log(mu / (1 - mu))
    for _ in range(40):
        w = n * mu * (1 - mu)
        z = eta + (p - mu) / (mu * (1 - mu))
        b = np.linalg.lstsq(x * np.sqrt(w)[:, None], z * np.sqrt(w), rcond=None)[0]
        eta = x @ b
        mu = 1 / (1 + np.exp(-eta))
    return b[0] - 2000 * b[1], b[1], b[2]


def sample(seed, years=range(2000, 2012), ages=range(0, 81), drop=0.1):
    rng = np.random.default_rng(seed)
    return [(y, a, float(round(1000 * math.exp(-0.03 * a) * rng.uniform(0.5, 1.5))) + 1)
            for y in years for a in ages if rng.uniform() > drop]


def test_fit_matches_numpy(rows):
    groups = {f"p{i}": sample(i) for i in range(3)}
    df = rows([(k, *r) for k, data in groups.items() for r in data], SCHEMA)
    got = {r.place: r for r in model.fit_grouped_logit(df, ["place"]).collect()}
    for place, data in groups.items():
        want = numpy_fit(data)
        for value, target in zip((got[place].b0, got[place].b_year, got[place].b_age), want):
            assert math.isclose(value, target, rel_tol=1e-8, abs_tol=1e-8)


def test_split_rows_and_null_keys_give_the_same_model(rows):
    data = sample(7)
    whole = model.fit_grouped_logit(rows([(None, *r) for r in data], SCHEMA), ["place"]).first()
    assert whole.place is None
    want = numpy_fit(data)
    assert math.isclose(whole.b_age, want[2], rel_tol=1e-8)


def test_duplicate_cells_keep_their_weight(rows):
    data = sample(8, years=range(2000, 2004), ages=range(5))
    twice = data + data
    got = model.fit_grouped_logit(rows([("a", *r) for r in twice], SCHEMA), ["place"]).first()
    want = numpy_fit(twice)
    assert math.isclose(got.b0, want[0], rel_tol=1e-7, abs_tol=1e-7)
    assert math.isclose(got.b_age, want[2], rel_tol=1e-7)


def test_constant_and_repeated_predictors(rows):
    one_year = [("y", 2005, a, float(10 + a)) for a in range(4)]
    one_age = [("a", y, 3, 5.0) for y in range(2000, 2003)]
    line = [("l", 2000 + a, a, float(1 + a)) for a in range(4)]
    spot = [("s", 2000, 1, 5.0)]
    got = {r.place: r for r in model.fit_grouped_logit(
        rows(one_year + one_age + line + spot, SCHEMA), ["place"]).collect()}
    assert got["y"].b_year is None and got["y"].b_age is not None
    assert got["a"].b_age is None and got["a"].b_year is not None
    assert got["l"].b_age is None and got["l"].b_year is not None
    assert got["s"].b_age is None and got["s"].b_year is None
    assert all(math.isfinite(r.b0) for r in got.values())


def test_null_and_zero_totals_leave_the_fit(rows):
    good = sample(9, years=range(2000, 2004), ages=range(6), drop=0)
    bad = [(2004, 0, None), (2004, 1, 5.0), (2005, 0, 0.0), (2005, 1, 0.0)]
    got = model.fit_grouped_logit(rows([("a", *r) for r in good + bad], SCHEMA), ["place"]).first()
    want = numpy_fit(good)
    assert math.isclose(got.b_age, want[2], rel_tol=1e-8)


def coefs(rows):
    return rows([("a", -1.0, 0.001, -0.05), ("b", -2.0, None, -0.1)],
                "place string, b0 double, b_year double, b_age double")


def test_disaggregated_ages_sum_to_the_total(rows, spark):
    totals = rows([("a", 2016, 1000.0), ("a", 2017, 0.0), ("b", 2016, None), ("b", 2018, 50.0)],
                  "place string, year int, population double")
    ages = spark.range(30).select(F.col("id").cast("int").alias("age"))
    out = model.disaggregate(totals, ages, coefs(rows), ["place"])
    sums = {(r.place, r.year): r.s for r in out.groupBy("place", "year").agg(
        F.sum("population").alias("s")).collect()}
    assert out.count() == 4 * 30 and sums[("b", 2016)] is None
    assert math.isclose(sums[("a", 2016)], 1000.0) and math.isclose(sums[("b", 2018)], 50.0)


def test_missing_years_and_ages_have_no_share(rows, spark):
    df = rows([("b", None, 10), ("b", 2016, None), ("a", 2016, 900)], "place string, year int, age int")
    got = {(r.year, r.age): r.predicted for r in model.score(df, coefs(rows), ["place"]).collect()}
    # the model of "b" has no year in it, but a row without one is still unknown
    assert got[(None, 10)] is None and got[(2016, None)] is None
    eta = -1.0 + 0.001 * 2016 - 0.05 * 900
    assert math.isclose(got[(2016, 900)], 1 / (1 + math.exp(-eta)), rel_tol=1e-12)
    totals = rows([("a", None, 100.0)], "place string, year int, population double")
    ages = spark.range(4).select(F.col("id").cast("int").alias("age"))
    out = model.disaggregate(totals, ages, coefs(rows), ["place"]).collect()
    assert len(out) == 4 and all(r.population is None for r in out)


def test_domain_of_many_ages(rows, spark):
    totals = rows([("a", 2016, 1000.0), ("a", 2016, 10.0), ("b", 2018, 50.0)],
                  "place string, year int, population double")
    ages = spark.range(3000).select((F.col("id") % 1500).cast("int").alias("age"))
    out = model.disaggregate(totals, ages, coefs(rows), ["place"])
    sums = {r.place: (r.n, r.s) for r in out.groupBy("place").agg(
        F.count("*").alias("n"), F.sum("population").alias("s")).collect()}
    # equal totals share their weights: both copies of a year are normalised together
    assert sums["a"][0] == 3000 and math.isclose(sums["b"][1], 50.0)


def test_keys_that_do_not_converge_are_marked_and_refused(rows, spark):
    split = [("cut", 2000, a, 100.0 if a < 3 else 0.0) for a in range(6)]
    good = [("good", *r) for r in sample(3, years=range(2000, 2004), ages=range(6), drop=0)]
    fitted = model.fit_grouped_logit(rows(split + good, SCHEMA), ["place"])
    # the deviance of the parted key comes to rest though its coefficients do not
    assert {r.place: r.converged for r in fitted.collect()} == {"good": True, "cut": True}
    few = model.fit_grouped_logit(rows(split + good, SCHEMA), ["place"], max_rounds=6)
    assert {r.place: r.converged for r in few.collect()} == {"good": True, "cut": False}
    short = model.fit_grouped_logit(rows(good, SCHEMA), ["place"], max_rounds=1)
    assert short.first().converged is False
    totals = rows([("good", 2016, 1.0)], "place string, year int, population double")
    ages = spark.range(3).select(F.col("id").cast("int").alias("age"))
    with pytest.raises(PySparkException, match="no converged model"):
        model.disaggregate(totals, ages, short, ["place"]).collect()


def test_missing_model_fails(rows, spark):
    totals = rows([("z", 2016, 1.0)], "place string, year int, population double")
    ages = spark.range(3).select(F.col("id").cast("int").alias("age"))
    with pytest.raises(PySparkException, match="no converged model"):
        model.disaggregate(totals, ages, coefs(rows), ["place"]).collect()


def test_score(rows):
    df = rows([("b", 2016, 10)], "place string, year int, age int")
    got = model.score(df, coefs(rows), ["place"]).first().predicted
    assert math.isclose(got, 1 / (1 + math.exp(3.0)))


def test_key_names_of_the_fit_are_refused(rows):
    df = rows([("a", 2000, 1, 1.0)], "p string, year int, age int, population double")
    with pytest.raises(ValueError, match="rename"):
        model.fit_grouped_logit(df, ["p"])


def some_lines(path, spark, known):
    """A lineitem table whose keys ``known`` have models; every year of the others has a NULL population."""
    flags, made = [("A", "F"), ("N", "O"), ("R", "F")], []
    for flag in flags:
        for year in range(1995, 1998):
            for line in range(1, 5):
                order = 12 if flag in known else 4999 * 3 + 11
                made.append((order, line, 10.0 + 3 * line + year % 3, 100.0, *flag, f"{year}-05-01"))
    spark.createDataFrame(made, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                "l_returnflag string, l_linestatus string, l_shipdate string").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


@pytest.mark.parametrize("known", [[("A", "F"), ("N", "O")], []])
@pytest.mark.parametrize("name", ["disaggregate", "grouped_score"])
def test_queries_leave_out_keys_without_a_model_as_their_sql_does(spark, tmp_path, name, known):
    path, con = some_lines(tmp_path, spark, known), duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{path}/lineitem.parquet/*.parquet'")
    n, problems = compare(QUERIES[name](spark, path), con, ORACLES[name])
    assert not problems and (n > 0) == bool(known)


def test_dropping_rows_without_a_model_still_refuses_models_that_did_not_converge(rows):
    marked = coefs(rows).withColumn("converged", F.col("place") == "a")
    df = rows([("z", 2016, 10), ("a", 2016, 10)], "place string, year int, age int")
    assert [r.place for r in model.score(df, marked, ["place"], no_model="drop").collect()] == ["a"]
    bad = rows([("b", 2016, 10)], "place string, year int, age int")
    with pytest.raises(PySparkException, match="no converged model"):
        model.score(bad, marked, ["place"], no_model="drop").collect()
    with pytest.raises(ValueError, match="no_model"):
        model.score(df, marked, ["place"], no_model="skip")
