"""Scans, snapshots, reports, joins and the shared folder."""

import pytest
from pyspark.sql import functions as F

from midyear.operators import joins, shape
from midyear.plans.population import check_names, harmonise
from midyear.sources import scans, shared, snapshots


def test_shared_folder_is_the_configured_one(spark):
    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = shared.cut_lineage(spark.range(5).withColumn("v", F.lit(None).cast("string")))
    assert df.count() == 5 and df.dtypes == [("id", "bigint"), ("v", "string")]


def test_scan_by_pattern_and_records(spark, tmp_path):
    for year, extra in ((2009, "Sexo"), (2010, "OTRO")):
        spark.createDataFrame([(1, "x")], ["AÑOOCU", extra]).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "tmp" / f"births_{year}"))
        for f in (tmp_path / "tmp" / f"births_{year}").glob("*.parquet"):
            (tmp_path / f"births_{year}.parquet").write_bytes(f.read_bytes())
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "deaths_2009.parquet"))
    df = scans.read_records(spark, str(tmp_path), "births_20")
    got = {tuple(r) for r in df.select("file_year", "anoocu", "sexo", "otro").collect()}
    assert got == {("2009", "1", "x", None), ("2010", "1", None, "x")}


def test_read_cells(spark, tmp_path):
    schema = "file string, sheet string, row_idx int, col_idx int, value string"
    spark.createDataFrame([("f", "s", 1, 1, None)], schema).write.parquet(str(tmp_path / "c"))
    assert scans.read_cells(spark, str(tmp_path / "c")).dtypes[2] == ("row_idx", "int")


def test_snapshot_prunes_years(spark, tmp_path):
    df = spark.range(20).select((2000 + F.col("id") % 4).cast("int").alias("year"), "id")
    path = str(tmp_path / "snap")
    snapshots.write_snapshot(df, path)
    back = snapshots.read_snapshot(spark, path, df.schema)
    assert sorted(back.select("year", "id").collect()) == sorted(df.collect())
    plan = back.filter("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    with pytest.raises(Exception):
        snapshots.write_snapshot(df, path)


def test_csv_null_marker(rows, spark, tmp_path):
    df = rows([("a", None), (None, 1.5)], "place string, population double")
    path = str(tmp_path / "csv")
    snapshots.write_csv(df.coalesce(1), path)
    text = next((tmp_path / "csv").glob("*.csv")).read_text()
    assert text.splitlines() == ["place,population", "a,NA", "NA,1.5"]
    assert set(snapshots.read_csv(spark, path, df.schema).collect()) == set(df.collect())


def test_null_keys_match(rows):
    left = rows([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    right = rows([("a", 10), (None, 20)], "k string, y int")
    got = {tuple(r) for r in joins.natural_left_join(left, right).collect()}
    assert got == {("a", 1, 10), (None, 2, 20), ("b", 3, None)}
    assert joins.join_on(left, right, ["k"], "left_anti").collect() == [("b", 3)]
    renamed = joins.join_on(left, right.withColumnRenamed("k", "code"), {"k": "code"})
    assert renamed.columns == ["k", "x", "y"]


def test_name_gate_looks_at_names_only(rows):
    known = rows([("d", "m"), ("e", None)], "department string, municipality string")
    projected = rows([("other", "m"), ("e", None)], "department string, municipality string")
    check_names(projected, known)
    with pytest.raises(ValueError):
        check_names(projected.union(rows([("d", "n")], projected.schema)), known)


def test_harmonise(rows):
    df = rows([("Huehetenango", " Concepcion "), ("Peten", "Concepcion"), (None, "Petapa"),
               (" Jalapa", "Petapa")], "department string, municipality string")
    got = [tuple(r) for r in harmonise(df).collect()]
    assert got == [("Huehuetenango", "Concepcion Huista"), ("Peten", "Concepcion"), (None, None),
                   ("Jalapa", "San Miguel Petapa")]


def test_expand_over_large_domain_is_whole(spark):
    df = spark.range(30).union(spark.range(30))
    source = spark.range(4000).select((F.col("id") % 1500).alias("age"))
    got = shape.expand_over(df, source, "age")
    assert got.count() == 60 * 1500 and got.distinct().count() == 30 * 1500
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_unpivot_counts_rows_times_columns(rows):
    df = rows([(1, None, 2.0), (2, 3.0, None)], "id int, a double, b double")
    assert shape.wide_to_long(df, ["id"], ["a", "b"]).count() == 4


def test_records_by_name_with_accents_and_other_orders(spark, tmp_path):
    (tmp_path / "births_2009.csv").write_text("depreg,mupreg,sexo\n6,1,2\n")
    (tmp_path / "births_2010.csv").write_text("sexo,depreg,mupreg\n2,6,1\n")
    df = scans.read_records(spark, str(tmp_path), "births", "csv", header="true")
    got = {tuple(r) for r in df.select("file_year", "depreg", "mupreg", "sexo").collect()}
    assert got == {("2009", "6", "1", "2"), ("2010", "6", "1", "2")}

    for year, name in ((2011, "año"), (2012, "ano")):
        rows = spark.createDataFrame([(year, 1.5 if year == 2011 else "x")], [name, "v"])
        rows.coalesce(1).write.parquet(str(tmp_path / f"tmp{year}"))
        part = next((tmp_path / f"tmp{year}").glob("*.parquet"))
        (tmp_path / f"deaths_{year}.parquet").write_bytes(part.read_bytes())
    df = scans.read_records(spark, str(tmp_path), "deaths")
    assert {tuple(r) for r in df.select("file_year", "ano", "v").collect()} == {
        ("2011", "2011", "1.5"), ("2012", "2012", "x")}


def test_cells_from_text_with_a_header(spark, tmp_path):
    (tmp_path / "cells.csv").write_text("file,sheet,row_idx,col_idx,value\nf,s,1,2,x\n")
    got = scans.read_cells(spark, str(tmp_path / "cells.csv"), "csv", header="true").collect()
    assert [tuple(r) for r in got] == [("f", "s", 1, 2, "x")]


def test_run_folder_goes_with_the_run(spark):
    from pathlib import Path

    with shared.run_folder(spark) as folder:
        shared.cut_lineage(spark.range(3))
        assert list(Path(folder).iterdir())
    assert not Path(folder).exists()
    assert "run-" not in shared.fresh_path(spark, "stage").rsplit("/", 1)[1]


def test_override_tables_have_one_row_per_key(rows):
    places = rows([("a", "x"), ("b", "y"), (None, "z")], "k string, name string")
    once = rows([("a", "new"), ("a", "new"), (None, None)], "k string, replacement string")
    got = {tuple(r) for r in joins.override_from_table(places, once, ["k"], "name").collect()}
    assert got == {("a", "new"), ("b", "y"), (None, "z")}
    twice = rows([("a", "new"), ("a", "other")], "k string, replacement string")
    with pytest.raises(Exception, match="two values"):
        joins.override_from_table(places, twice, ["k"], "name").collect()


def test_places_without_a_department(rows):
    from midyear.plans.population import standardise

    df = rows([(None, "Flores"), (None, "Concepción"), ("HUEHUETENANGO", "concepcion"), ("Peten", "concepcion"),
               (None, None)], "department string, municipality string")
    got = [tuple(r) for r in standardise(df).collect()]
    assert got == [(None, "Flores"), (None, None), ("Huehuetenango", "Concepcion Huista"),
                   ("Peten", "Concepcion"), (None, None)]


def test_nested_rows_are_kept(rows):
    df = rows([("a", 1, "x"), ("a", 1, "x"), ("b", None, None)], "k string, n int, v string")
    assert sorted(shape.unnest(shape.nest(df, ["k"]), "data").collect(), key=str) == sorted(df.collect(), key=str)
