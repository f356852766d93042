"""Workbooks derived from given tables, on rows of their own."""

import duckdb
import pytest

from midyear.catalog import ORACLES, QUERIES
from oracle import compare


@pytest.fixture
def many(spark, tmp_path):
    """Suppliers of workbooks 1, 10, 100 and 1,000 of two regions, and their line items."""
    keys = [0, 1, 180, 181, 1980, 1981, 19_980, 19_981]
    spark.createDataFrame([(k, f"Supplier#{k:09d}") for k in keys], "s_suppkey long, s_name string").write.parquet(
        str(tmp_path / "supplier.parquet"))
    spark.createDataFrame(
        [(i, n) for i, n in enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])],
        "r_regionkey int, r_name string").write.parquet(str(tmp_path / "region.parquet"))
    spark.createDataFrame(
        [(k, line, float((k * 7 + line * 5 + year * 3) % 11 + 2 * line), status, f"{year}-05-01 00:00:00") for k in keys for line in (1, 2, 3)
         for year in (1995, 1996, 1997) for status in "OF" if (k + line + year) % 7],
        "l_suppkey long, l_linenumber int, l_quantity double, l_linestatus string, at string",
    ).selectExpr("* except (at)", "timestamp(at) AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    for name in ("supplier", "region", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    return str(tmp_path), con


@pytest.mark.parametrize("name", [
    "layout_2000", "year_sections", "place_columns", "layout_2011", "population_table", "population_snapshot"])
def test_workbooks_from_number_100_on_stay_apart(spark, many, name):
    folder, con = many
    n, problems = compare(QUERIES[name](spark, folder), con, ORACLES[name])
    assert n and not problems
