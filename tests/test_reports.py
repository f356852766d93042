"""Exact sums, bands from a table, hot NULL keys, snapshots with a manifest, ordered reports, gates."""

import math
import random

import pytest
from pyspark.sql import functions as F

from midyear.functions.numbers import exact_sum
from midyear.operators import model
from midyear.operators.intervals import interval_rollup, running_totals
from midyear.operators.joins import join_on, written_if_none
from midyear.operators.totals import group_mean, group_sum, share_of_total
from midyear.sources import snapshots

# --- sums ------------------------------------------------------------------------------


def _bits(frame):
    return sorted((tuple(v.hex() if isinstance(v, float) else v for v in r) for r in frame.collect()), key=str)


def test_sums_do_not_depend_on_partitions(rows):
    rng = random.Random(4)
    data = [(rng.choice("ab"), rng.choice([1e16, 1.0, 1e-9, 0.1, -1e16, 3.3]) * rng.random()) for _ in range(900)]
    frame = rows(data, "k string, v double")
    for operator in (lambda f: group_sum(f, ["k"], "v"), lambda f: group_mean(f, ["k"], "v"),
                     lambda f: share_of_total(f, ["k"], "v").select("k", "proportion")):
        got = [_bits(operator(frame.orderBy(F.rand(n)).repartition(n))) for n in (1, 7, 64)]
        assert got[0] == got[1] == got[2]
    for r in group_sum(frame, ["k"], "v").collect():
        assert r.v == pytest.approx(math.fsum(v for k, v in data if k == r.k), rel=1e-15)


@pytest.mark.parametrize("values, want", [
    ([1e16, 1.0, -1e16], 1.0), ([0.1] * 10, 1.0), ([], None), ([None, None], None), ([2.0**80, 2.0**-100, -(2.0**80)], 2.0**-100),
    ([math.inf, 1.0], math.inf), ([math.inf, -math.inf], math.nan), ([math.nan, 5.0], math.nan), ([-0.0], 0.0), ([None, 2.5], 2.5)])
def test_exact_sums(rows, values, want):
    got = rows([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0]
    assert (got is None) if want is None else math.isnan(got) if math.isnan(want) else got == want


def test_fits_and_projections_do_not_depend_on_partitions(spark):
    people = spark.range(2000).selectExpr(
        "nullif(cast(id % 7 AS string), '3') AS k", "cast(2000 + id % 10 AS int) AS year", "cast(id % 13 AS int) AS age",
        "cast(1 + (id * 7919) % 101 AS double) / 7 AS population")
    totals = people.groupBy("k", "year").agg(F.max("population").alias("population"))
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            coefs = model.fit_grouped_logit(people.repartition(n), ["k"])
            found.append((_bits(coefs), _bits(model.disaggregate(totals.repartition(n), people, coefs, ["k"]))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_rounds_exchange_nothing_but_coefficients(spark):
    people = spark.range(500).selectExpr(
        "cast(id % 5 AS string) AS k", "cast(2000 + id % 4 AS int) AS year", "cast(id % 11 AS int) AS age",
        "cast(1 + id % 17 AS double) AS population")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = model.cut_lineage(model.model_cells(people, ["k"]))
        with model._by_bucket(cells, ["k"]) as (bucketed, _):
            state = spark.sql(model.DESIGN, cells=bucketed)
            for step in range(2):
                for _ in range(model.ROUNDS_PER_JOB):
                    state = model._round(bucketed, state)
                plan = state._jdf.queryExecution().executedPlan().toString()
                assert plan.count("Exchange hashpartitioning") == step, plan  # the coefficients of the last step
                state = model.cut_lineage(state)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- bands from a table ------------------------------------------------------------------


@pytest.mark.parametrize("chunks", [1, 5])
@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(12,2)"])
def test_bands_of_a_table(rows, chunks, kind):
    rng = random.Random(chunks)
    # NULL and whole values; half of the rows belong to one key
    data = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(60)]), rng.choice([*range(1, 9), None] if i % 40 == 0 else range(1, 9)))
            for i in range(400)]
    bands = [(f"b{rng.randint(0, 150)}", rng.choice([None, *range(-5, 60)]), rng.randint(-5, 70)) for _ in range(200)] + [("one", 3, 3)] * 2
    want = {}
    for name, low, high in set(bands):
        for k, at, v in data:
            if at is not None and low is not None and low <= at <= high:
                want.setdefault((k, name), []).append(v)
    frame = rows(data, "k string, at int, v bigint").withColumn("v", F.col("v").cast(kind)).repartition(3)
    out = interval_rollup(frame, ["k"], "at", "v", rows(bands, "band string, low int, high int"), chunks)
    assert out.schema["v"].dataType == frame.schema["v"].dataType or kind.startswith("decimal")
    got = {(r.k, r.band): r.v for r in out.collect()}
    assert got == {key: None if None in found else sum(found) for key, found in want.items()}


def test_small_bands_behind_large_totals(rows):
    data = [("a", 1, 1e15 / 3), ("a", 2, 0.25), ("a", 3, math.nan), ("a", 4, 0.5)]
    bands = rows([("x", 2, 2), ("y", 4, 9), ("z", 3, 4), ("none", 5, 9)], "band string, low int, high int")
    got = {r.band: r.v for r in interval_rollup(rows(data, "k string, at int, v double"), ["k"], "at", "v", bands).collect()}
    assert got == {"x": 0.25, "y": 0.5, "z": None}
    assert interval_rollup(rows([], "k string, at int, v double"), ["k"], "at", "v", bands).collect() == []


def test_running_totals_over_chunks(spark):
    frame = spark.range(1000).selectExpr("id % 2 AS k", "id AS at", "1L AS one")
    got = {(r.k, r.at): r.one for r in running_totals(frame, ["k"], "at", ["one"], chunks=7).collect()}
    assert all(got[at % 2, at] == at // 2 + 1 for at in range(1000))


# --- NULL keys ---------------------------------------------------------------------------


def test_null_keys_are_spread(spark, rows):
    left = spark.range(20_000, numPartitions=8).selectExpr("id", "IF(id % 2 = 0, NULL, id % 50) AS k", "nullif(id % 3, 1) AS m")
    right = rows([(None, None, "none"), (None, 2, "half"), (7, 0, "seven"), (8, None, "eight")], "k bigint, m bigint, name string")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, value in zip(before, ("false", "-1")):
            spark.conf.set(c, value)
        for how in ("left", "inner", "left_semi", "left_anti"):
            plain, spread = (join_on(left, right, ["k", "m"], how, n) for n in (1, 32))
            assert spread.columns == plain.columns
            assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
        largest = lambda f: max(r["count"] for r in f.groupBy(F.spark_partition_id()).count().collect())
        assert largest(join_on(left, right, ["k"], null_salts=32)) < largest(join_on(left, right, ["k"]))
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    with pytest.raises(ValueError):
        join_on(left, right, ["k"], "full", 4)


# --- snapshots and reports ---------------------------------------------------------------


YEARS = "year int, v string"


def _read(spark, path):
    return sorted(map(tuple, snapshots.read_snapshot(spark, path, "v string, year int").select("year", "v").collect()))


def test_a_rerun_replaces_its_years_alone(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    snapshots.write_years(rows([(2001, "a"), (2002, "b"), (None, "n")], YEARS), path)
    snapshots.write_years(rows([(2002, "c"), (2003, "d")], YEARS), path)
    got = snapshots.read_snapshot(spark, path, "v string, year int").collect()
    assert {(r.year, r.v) for r in got} == {(2001, "a"), (2002, "c"), (2003, "d"), (None, "n")}
    assert snapshots.sweep(spark, path) == 1  # the old 2002
    assert {(r.year, r.v) for r in snapshots.read_snapshot(spark, path, "v string, year int").collect()} == {
        (r.year, r.v) for r in got}


def test_a_run_that_breaks_off_leaves_the_old_snapshot(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    snapshots.write_years(rows([(2001, "a"), (2002, "b")], YEARS), path)
    with monkeypatch.context() as broken:
        def stop(*args):
            raise KeyboardInterrupt
        broken.setattr(snapshots, "switch", stop)
        with pytest.raises(KeyboardInterrupt):
            snapshots.write_years(rows([(2002, "new"), (2003, "new")], YEARS), path)
    assert _read(spark, path) == [(2001, "a"), (2002, "b")]
    folders = snapshots.manifest(spark, path)
    with pytest.raises(RuntimeError):  # another run has switched meanwhile
        snapshots.switch(spark, path, folders, 0)
    assert snapshots.sweep(spark, path) == 2 and _read(spark, path) == [(2001, "a"), (2002, "b")]
    snapshots.write_years(rows([(2002, "again")], YEARS), path)
    assert _read(spark, path) == [(2001, "a"), (2002, "again")]


@pytest.mark.parametrize("parts", [1, 6])
def test_a_report_is_one_ordered_file(spark, tmp_path, parts):
    path = str(tmp_path / "r.csv")
    frame = spark.range(3000).repartition(parts).selectExpr("id % 7 AS a", "nullif(cast(id AS string), '13') AS `b,c`")
    snapshots.write_ordered_csv(frame.orderBy(F.desc("a"), F.length("`b,c`"), "`b,c`"), path)
    lines = (tmp_path / "r.csv").read_text().splitlines()
    want = sorted(((i % 7, None if i == 13 else str(i)) for i in range(3000)), key=lambda r: (-r[0], len(r[1] or ""), r[1] or ""))
    assert lines == ['a,"b,c"', *[f"{a},{'NA' if b is None else b}" for a, b in want]]
    with pytest.raises(FileExistsError):
        snapshots.write_ordered_csv(frame, path)
    empty = str(tmp_path / "e.csv")
    snapshots.write_ordered_csv(frame.limit(0), empty)
    assert (tmp_path / "e.csv").read_text() == 'a,"b,c"\n'


def test_gates_count_while_they_write(spark, rows):
    frame = rows([(1, 0.1), (2, None)], "k int, v double")
    assert written_if_none(frame, F.col("v") > 1, "no").count() == 2
    with pytest.raises(ValueError, match="too large"):
        written_if_none(frame, F.col("v") > 0, "too large")
