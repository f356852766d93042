"""Sections, fills and previous rows do not depend on the number of chunks."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from midyear.operators import ordered

SCHEMA = "g string, i int, mark boolean, v string"


def brute(data):
    """Section, head position and head value of every row, and the value before it."""
    out = {}
    for g in {r[0] for r in data}:
        rows = sorted((r for r in data if r[0] == g), key=lambda r: r[1])
        section, head, before = 0, rows[0], None
        for r in rows:
            if r[2]:
                section, head = section + 1, r
            out[(g, r[1])] = (section, head[1], head[3], before)
            before = r[3]
    return out


def run(spark, data, chunks):
    df = spark.createDataFrame(data, SCHEMA)
    df = ordered.sections(df, ["g"], "i", F.col("mark"), {"head": F.col("v")}, chunks=chunks)
    df = ordered.previous(df, ["g"], "i", "v", "before", chunks=chunks)
    return {
        (r.g, r.i): (r.section, r.section_start, r["head"], r.before) for r in df.collect()
    }


rows_of_groups = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 40),
              st.sampled_from([True, False, False, None]),
              st.sampled_from(["x", "y", None])),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows_of_groups)
def test_any_number_of_chunks_gives_the_same_sections(spark, data):
    expected = brute(data)
    for chunks in (1, 3, 11):
        assert run(spark, data, chunks) == expected


def test_hot_group_is_split(spark):
    """One group with all rows, at order values far apart and unevenly spread: each chunk has its share."""
    place = F.when(F.col("id") < 2500, F.col("id")).otherwise(F.col("id") * 1_000_003)
    df = spark.range(5000).select(
        F.lit("hot").alias("g"), place.alias("i"), (F.col("id") % 700 == 3).alias("mark"), "id")
    placed = ordered.place(df, ["g"], "i", chunks=10)
    sizes = [r["count"] for r in placed.groupBy(ordered.CHUNK).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 1000
    out = ordered.sections(placed, ["g"], "i", F.col("mark"))
    counts = {r.section: r["count"] for r in out.groupBy("section").count().collect()}
    assert counts == {0: 3, **{k: 700 for k in range(1, 8)}, 8: 97}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"windowspecdefinition\(__group#\d+, __chunk#\d+, i#", plan)


def test_numbered_and_first_rows(rows):
    df = rows([("a", 5), ("a", 2), ("b", 9)], "g string, i int")
    got = {(r.g, r.i): r.n for r in ordered.numbered(df, ["g"], "i", "n", 3).collect()}
    assert got == {("a", 2): 1, ("a", 5): 2, ("b", 9): 1}
    assert sorted(ordered.first_rows(df, ["g"], "i").collect()) == [("a", 2), ("b", 9)]
    assert ordered.without_first(df, ["g"], "i").collect() == [("a", 5)]


@pytest.mark.parametrize("target", ["v"])
def test_overwrite_first(rows, target):
    df = rows([("a", 2, "x"), ("a", 1, None)], "g string, i int, v string")
    got = ordered.overwrite_first(df, ["g"], "i", target, F.lit("year")).collect()
    assert sorted(got) == [("a", 1, "year"), ("a", 2, "x")]
