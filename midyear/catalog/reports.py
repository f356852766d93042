"""Bands from a table, hot NULL keys, snapshots that are rerun and ordered reports on the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from midyear.catalog.registry import derived, plain, query
from midyear.operators.intervals import interval_rollup
from midyear.operators.joins import join_on
from midyear.sources import snapshots
from midyear.sources.shared import fresh_path

# Positions are days; every supplier is a band that overlaps many others, some of two intervals.
_AMOUNTS = """
SELECT nullif(l_returnflag, 'R') AS flag, datediff(l_shipdate, DATE '1995-01-01') AS day,
  CASE WHEN l_orderkey % 5003 = 7 THEN NULL ELSE l_quantity END AS amount FROM {lineitem}"""
_BANDS = """
SELECT s_name AS band, cast((s_suppkey * 7919) % 2600 AS INT) AS low,
  cast((s_suppkey * 7919) % 2600 + s_suppkey % 300 AS INT) AS high FROM {supplier}
UNION ALL SELECT s_name, cast(3000 + s_suppkey AS INT), cast(3000 + s_suppkey % 400 AS INT) FROM {supplier}
UNION ALL SELECT s_name, cast(-100 + s_suppkey % 90 AS INT), cast(-5 AS INT) FROM {supplier}"""


@query("interval_bands", f"""
WITH a AS (SELECT nullif(l_returnflag, 'R') AS flag, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS day,
    CASE WHEN l_orderkey % 5003 = 7 THEN NULL ELSE l_quantity END AS amount FROM lineitem),
  d AS (SELECT flag, day, sum(amount) AS amount, count(*) AS n, count(amount) AS m FROM a GROUP BY ALL)
SELECT flag, band, CASE WHEN sum(n) = sum(m) THEN round(sum(amount), 6) END AS amount
FROM d JOIN (SELECT DISTINCT * FROM ({plain(_BANDS)}) b) b ON day BETWEEN low AND high GROUP BY flag, band""")
def _interval_bands(spark, sf):
    totals = interval_rollup(derived(spark, sf, _AMOUNTS), ["flag"], "day", "amount", derived(spark, sf, _BANDS))
    return totals.withColumn("amount", F.round("amount", 6))


# Half of the rows have no key.
_ITEMS = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE l_suppkey END AS code FROM {lineitem}"""
_NAMES = """
SELECT s_suppkey AS code, s_name AS name FROM {supplier} UNION ALL SELECT NULL, concat('no code, ', n_name) FROM {nation}
WHERE n_nationkey = 0"""


@query("null_keys", f"""
SELECT name, l_linenumber, count(*) AS n FROM ({plain(_ITEMS)}) i
LEFT JOIN ({plain(_NAMES)}) k ON i.code IS NOT DISTINCT FROM k.code GROUP BY ALL""")
def _null_keys(spark, sf):
    named = join_on(derived(spark, sf, _ITEMS), derived(spark, sf, _NAMES), ["code"], null_salts=16)
    return named.groupBy("name", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


_YEARS = """
SELECT cast(year(l_shipdate) AS INT) AS year, l_suppkey AS place, l_linestatus AS sex,
  sum(l_quantity) AS population FROM {lineitem} GROUP BY 1, 2, 3"""


@query("snapshot_rerun", f"""
WITH y AS ({plain(_YEARS)})
SELECT * FROM y WHERE year <> 1997
UNION ALL SELECT year, place, sex, population + 1 FROM y WHERE year = 1997 AND place % 2 = 0""")
def _snapshot_rerun(spark, sf):
    years, path = derived(spark, sf, _YEARS), fresh_path(spark, "yearly")
    snapshots.write_years(years, path)
    again = years.filter("year = 1997 AND place % 2 = 0").withColumn("population", F.col("population") + 1)
    snapshots.write_years(again, path)
    snapshots.sweep(spark, path)
    return snapshots.read_snapshot(spark, path, years.schema)


@query("ordered_report", f"""
SELECT row_number() OVER (ORDER BY place DESC, year, sex) AS line, place, year, sex FROM ({plain(_YEARS)}) y""")
def _ordered_report(spark, sf):
    rows = derived(spark, sf, _YEARS).select("place", "year", "sex")
    path = f"{fresh_path(spark, 'report')}.csv"
    snapshots.write_ordered_csv(rows.orderBy(F.desc("place"), "year", "sex"), path)
    read = snapshots.read_csv(spark, path, rows.schema).withColumns(
        {"block": F.col("_metadata.file_block_start"), "at": F.monotonically_increasing_id()})
    blocks = read.groupBy("block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block of the file
    shift = blocks.select("block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return read.join(shift, "block").select((F.col("at") + F.col("shift")).alias("line"), "place", "year", "sex")
