"""The composed population pipeline, from cell tables to the long table and its snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from midyear.catalog import layouts as books
from midyear.catalog.models import sql_fit
from midyear.catalog.registry import query
from midyear.catalog.scalars import sql_ascii, sql_title
from midyear.plans import layouts
from midyear.plans.population import (
    MODEL_KEYS, harmonise, population_table, standardise,
)
from midyear.operators.joins import unknown_names
from midyear.sources import snapshots
from midyear.sources.shared import fresh_path

# --- SQL counterpart --------------------------------------------------------------------


def _std(x: str) -> str:
    return sql_title(f"trim(lower({sql_ascii(x)}), ' ')")


_PAST = f"SELECT * FROM ({books.LONG_2000}) a UNION ALL SELECT * FROM ({books.LONG_2011}) b"
_PROJECTED = f"""
SELECT sex, type, year, {_std('department')} AS department, {_std('municipality')} AS municipality,
  population FROM ({books.LONG_2016}) t"""
_TABLE = f"""
WITH past AS MATERIALIZED ({_PAST}),
{sql_fit('SELECT * FROM past', MODEL_KEYS)},
grid AS (SELECT t.*, a.age, 1 / (1 + exp(-(b0 + b_year * t.year + b_age * a.age))) AS predicted
  FROM ({_PROJECTED}) t JOIN fit USING (department, municipality, sex),
    (SELECT DISTINCT age FROM past) a WHERE t.sex <> 'all' AND t.type = 'total')
SELECT year, department, municipality, sex, age, round(population, 3) AS population FROM past
UNION ALL
SELECT year, department, municipality, sex, age, round(population * predicted / sum(predicted) OVER (
  PARTITION BY department, municipality, sex, year), 3) FROM grid"""


def _books(spark, sf):
    """The three workbooks."""
    return (
        books.workbook(books.cells_2000(spark, sf)),
        books.workbook(books.cells_2011(spark, sf)),
        books.workbook(books.cells_2016(spark, sf)),
    )


@query("population_table", _TABLE)
def _population_table(spark, sf):
    table = population_table(*_books(spark, sf), **books.OPTIONS_2011)
    return table.withColumn("population", F.round("population", 3))


@query("population_snapshot", f"""
SELECT year, sex, count(*) AS n, round(sum(population), 1) AS population FROM ({_TABLE}) t
GROUP BY ALL""")
def _population_snapshot(spark, sf):
    path = fresh_path(spark, "population")
    table = population_table(*_books(spark, sf), **books.OPTIONS_2011)
    snapshots.write_snapshot(table, path)
    saved = snapshots.read_snapshot(spark, path, table.schema)
    return saved.groupBy("year", "sex").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.round("population", 3)), 1)
        .alias("population"))


@query("name_gate", f"""
SELECT department, municipality, count(*) AS n FROM ({_PROJECTED}) p
WHERE municipality NOT IN (SELECT municipality FROM ({books.LONG_2011}) k) GROUP BY ALL""")
def _name_gate(spark, sf):
    projected = standardise(layouts.layout_2016(books.workbook(books.cells_2016(spark, sf))))
    known = harmonise(layouts.layout_2011(books.workbook(books.cells_2011(spark, sf)),
                                          **books.OPTIONS_2011))
    return unknown_names(projected, known, "municipality", ["department", "municipality"])
