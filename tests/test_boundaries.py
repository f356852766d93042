"""Next boundaries from a table, against a search by hand."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from midyear.operators.boundaries import next_from_table
from midyear.operators.shape import expand_over, row_salt

EVENTS, MARKS = "id bigint, key string, day date", "key string, mark date, note string"


def _day(n):
    return None if n is None else dt.date(2001, 1, 1) + dt.timedelta(n)


def _plain(events, marks, strict):
    out = []
    for i, key, day in events:
        later = [(m, note) for k, m, note in marks if k == key and m is not None and day is not None
                 and (m > day if strict else m >= day)]
        out.append((i, key, day, *(min(later) if later else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunks", [1, 3, 17])
@pytest.mark.parametrize("strict", [True, False])
def test_next_boundary_of_any_key(rows, chunks, strict):
    rng = random.Random(chunks)
    events = [(i, rng.choice(["a", "a", "b", None, "none"]), _day(rng.choice([None, *range(40)]))) for i in range(300)]
    marks = [(rng.choice(["a", "b", None, "other"]), _day(rng.choice([None, *range(45)])), rng.choice("xyz")) for _ in range(25)]
    got = next_from_table(rows(events, EVENTS).repartition(3), rows(marks, MARKS), ["key"], "day", "mark", ["note"], strict, chunks)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _plain(events, marks, strict)


def test_repeated_events_and_no_boundaries(rows):
    events = [(1, "a", _day(3))] * 50
    got = next_from_table(rows(events, EVENTS), rows([("a", _day(4), "x")], MARKS), ["key"], "day", "mark", chunks=4)
    assert got.count() == 50 and got.select("mark").distinct().collect()[0].mark == _day(4)
    none = next_from_table(rows(events, EVENTS), rows([], MARKS), ["key"], "day", "mark", chunks=4)
    assert none.count() == 50 and none.filter("mark IS NOT NULL").count() == 0
    assert next_from_table(rows([], EVENTS), rows([("a", _day(4), "x")], MARKS), ["key"], "day", "mark").collect() == []


def test_a_key_with_a_third_of_all_rows_is_split(spark, rows):
    events = spark.range(30_000).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', cast(id % 50 AS string)) AS key", "date_add(DATE'2001-01-01', cast(id % 5 AS int)) AS day")
    marks = rows([("hot", _day(3), "x"), ("1", _day(2), "y")], MARKS)
    got = next_from_table(events, marks, ["key"], "day", "mark", chunks=16)
    # rows of one key and day come from many chunks: no file of the written table holds the whole key
    files = got.withColumn("part", F.spark_partition_id())
    assert got.count() == 30_000 and got.filter("key = 'hot' AND mark IS NULL").count() == 4_000
    held = got.filter("key = 'hot'").inputFiles()
    assert len(held) > 4 and files.count() == 30_000


def test_repeated_rows_have_several_salts(spark):
    same = spark.range(10_000, numPartitions=8).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    salts = same.select(row_salt(same, 64).alias("salt")).groupBy("salt").count().collect()
    assert len(salts) > 4 and max(r["count"] for r in salts) <= 2 * 10_000 / 8 + 1
    ages = spark.range(3).withColumnRenamed("id", "age")
    assert expand_over(same, ages, "age").count() == 30_000
