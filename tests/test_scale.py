"""Plans hold when one group owns a third of the rows."""

import pytest
from pyspark.sql import functions as F

from midyear.operators import cohort, totals
from midyear.operators.events import infant_deaths


@pytest.fixture
def no_broadcast(spark):
    """Joins beyond the broadcast size, with skew thresholds scaled to the test data."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_group_is_split_when_totals_are_joined_back(no_broadcast):
    df = no_broadcast.range(60_000).repartition(6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").cast("double").alias("v"))
    shares = totals.share_of_total(df, ["k"], "v", "share")
    plan = final_plan(shares)
    assert "SortMergeJoin(skew=true)" in plan and "Window" not in plan
    sums = shares.groupBy("k").agg(F.sum("share").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0 and shares.count() == 60_000


def test_counts_are_partial_before_the_shuffle(spark):
    births = spark.range(10).select(
        F.when(F.col("id") >= 0, "6").alias("mother_department"),
        F.col("id").cast("string").alias("mother_municipality"),
        F.expr("date_add(date'2010-01-01', cast(id as int))").alias("event_date"))
    places = spark.createDataFrame([("0601", "x")], "muni_id string, municipality string")
    out = cohort.births_at(births, cohort.mid_years(births), places)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_parsed_dates_are_not_copied_into_filters(spark):
    names = ("file_year anoreg mesreg anoocu mesocu diaocu perdif edadif depreg mupreg").split()
    raw = spark.createDataFrame([["2010", "10", "1", None, "1", "2", "1", "3", "6", "1"]],
                                ", ".join(f"{n} string" for n in names))
    out = infant_deaths(raw).filter(F.col("birth_date") > F.lit("2009-01-01").cast("date"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1 and out.count() == 1
