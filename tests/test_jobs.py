"""Both jobs end to end on hand-made files."""

from contextlib import nullcontext

import pytest
from pyspark.sql import functions as F

from midyear import jobs
from midyear.operators.bands import AGE_GROUPS
from midyear.sources.snapshots import read_snapshot
from test_layouts import CELLS, grid, sheet_2011


def workbooks(rows, tmp_path):
    old = grid(
        "/tmp/09 Quetzaltenango.xls", "Población TOTAL",
        ["2010", "Total", None, None, None, None, None],
        [None, "0", None, None, "Salcajá", None, None],
        ["Edad", "T", "M", "F", "T", "M", "F"],
        *[[str(a), "9", "4", "5", str(60 - 3 * a), str(30 - a), str(30 - 2 * a)]
          for a in range(6)],
    )
    new = sheet_2011("/tmp/09 Quetzaltenango.xls", "2011", 3, ["Salcaja"])
    new = [c for c in new if c[3] == 1 or c[4] not in (None, "?")]
    total = [
        grid("/tmp/p.xlsx", sheet, *[["t", None]] * 3, ["Departamento y Municipio", "Total"],
             [None, "2016"], [None, None], ["QUETZALTENANGO", "9"], [" Salcajá ", value])
        for sheet, value in (("Total", "300"), ("Hombres", "160"), ("Mujeres", "140"))
    ]
    paths = []
    for name, cells in (("a", old), ("b", new), ("c", sum(total, []))):
        path = str(tmp_path / name)
        rows(cells, CELLS).write.parquet(path)
        paths.append(path)
    return paths


RAW_BIRTHS = ("anoreg mesreg anoocu mesocu diaocu libras onzas sexo tipar viapar pueblopm pueblopp "
              "depocu mupocu depreg mupreg deprem muprem edadm").split()
RAW_DEATHS = "anoreg mesreg anoocu mesocu diaocu perdif edadif depreg mupreg".split()


def test_both_jobs(spark, rows, tmp_path, monkeypatch):
    out = str(tmp_path / "population")
    jobs.population_job(spark, *workbooks(rows, tmp_path), out)
    population = read_snapshot(spark, out)
    projected = population.filter("year = 2016").groupBy("sex").agg(
        F.round(F.sum("population"), 6).alias("s"))
    assert {tuple(r) for r in projected.collect()} == {("male", 160.0), ("female", 140.0)}
    assert {r.municipality for r in population.select("municipality").distinct().collect()} == {
        "Salcaja"}

    # Births spread evenly over the year before mid-2016, so that shares are near uniform.
    days = spark.sql("SELECT explode(sequence(date'2015-07-01', date'2016-06-30')) AS d")
    fixed = {"deprem": "9", "muprem": "2", "sexo": "1"}
    births = days.select(*[
        (F.lit("15") if n == "anoreg" else F.lit(None) if n == "anoocu"
         else F.month("d") if n == "mesocu" else F.dayofmonth("d") if n == "diaocu"
         else F.lit(fixed.get(n, "1"))).cast("string").alias(n.upper()) for n in RAW_BIRTHS
    ], F.year("d").alias("y"))
    records = tmp_path / "records"
    records.mkdir()

    def one_file(df, name):
        df.coalesce(1).write.parquet(str(tmp_path / f"tmp_{name}"))
        part = next((tmp_path / f"tmp_{name}").glob("*.parquet"))
        (records / f"{name}.parquet").write_bytes(part.read_bytes())

    for year in (2015, 2016):
        one_file(births.filter(F.col("y") == year).drop("y"), f"births_{year}")
    death = ["16", "5", "2016", "5", "20", "1", "3", "9", "0902"]
    one_file(rows([death], ", ".join(f"{n} string" for n in RAW_DEATHS)), "deaths_2016")
    places = str(tmp_path / "places")
    rows([("0902", "Salcajá")], "cod_muni string, municipio string").write.parquet(places)

    report = str(tmp_path / "report")
    jobs.under_five_job(spark, str(records), places, out, report)
    got = spark.read.option("header", True).csv(report).filter("year = 2016").collect()
    assert {r.age_group for r in got} == set(AGE_GROUPS)
    by_group = {r.age_group: float(r.population) for r in got}
    assert by_group["0-59 months"] == pytest.approx(
        by_group["0-11 months"] + by_group["12-59 months"])

    # the same records as text, with the columns of one year in another order
    texts = tmp_path / "texts"
    texts.mkdir()
    for file in records.iterdir():
        df = spark.read.parquet(str(file)).toPandas()
        back = list(df.columns)[::-1] if "2016" in file.name else list(df.columns)
        df[back].to_csv(texts / f"{file.stem}.csv", index=False)
    spark.read.parquet(places).toPandas().to_csv(tmp_path / "places.csv", index=False)
    again = str(tmp_path / "again")
    jobs.under_five_job(spark, str(texts), str(tmp_path / "places.csv"), out, again, "csv")
    rest = spark.read.option("header", True).csv(again).filter("year = 2016").collect()
    assert sorted(map(tuple, rest)) == sorted(map(tuple, got))


def test_command_line(monkeypatch):
    calls = []
    monkeypatch.setattr(jobs, "build_session", lambda name: "session")
    monkeypatch.setattr(jobs, "run_folder", lambda spark: nullcontext())
    monkeypatch.setattr(jobs, "population_job", lambda *a, **k: calls.append((a, k)))
    jobs.main(["population", "a", "b", "c", "d"])
    assert calls == [(("session",), {"cells_2000": "a", "cells_2011": "b", "cells_2016": "c",
                                     "out": "d"})]
    with pytest.raises(SystemExit):
        jobs.main(["other"])
