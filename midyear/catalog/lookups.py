"""Joins, gates, sources and sinks on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from midyear.catalog import raw
from midyear.catalog.registry import derived, query, table
from midyear.catalog.scalars import sql_ascii, sql_boundary, sql_case, sql_title
from midyear.functions.dates import next_boundary
from midyear.functions.recode import recode
from midyear.operators import joins
from midyear.operators.boundaries import next_from_table
from midyear.operators.cohort import mid_years
from midyear.operators.shape import map_columns, year_rows
from midyear.operators.totals import group_count
from midyear.plans.population import (
    DEPARTMENT_NAMES, PLACE_NAMES, PROJECTED_NAMES, SCOPED_NAMES,
    harmonise, standardise,
)
from midyear.plans.vital import place_names
from midyear.sources import scans, snapshots
from midyear.sources.shared import fresh_path

# --- lookups and overrides ------------------------------------------------------------


@query("code_lookup", """
SELECT c_custkey, code, n_name FROM (SELECT c_custkey,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_nationkey + c_custkey % 3 END AS code
  FROM customer) c LEFT JOIN nation ON code = n_nationkey""")
def _code_lookup(spark, sf):
    key = F.col("c_custkey")
    code = F.when(key % 9 != 0, F.col("c_nationkey") + key % 3)
    c = table(spark, sf, "customer").select("c_custkey", code.alias("code"))
    places = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return joins.code_lookup(c, places, "code", "n_nationkey")


_OVERRIDES = {3: "San Andres", 7: "San Felipe", 24: "Quezada"}


@query("code_override", f"""
SELECT c_custkey, {sql_case('c_nationkey', _OVERRIDES, 'n_name')} AS n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _code_override(spark, sf):
    c = joins.code_lookup(table(spark, sf, "customer"), table(spark, sf, "nation"),
                          "c_nationkey", "n_nationkey")
    return joins.override_by_code(c, "c_nationkey", "n_name", _OVERRIDES).select(
        "c_custkey", "n_name")


@query("table_override", """
SELECT c_custkey, coalesce(s_name, c_name) AS c_name FROM customer
LEFT JOIN supplier ON c_custkey = s_suppkey AND c_nationkey = s_nationkey""")
def _table_override(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name")
    overrides = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_name").alias("replacement"))
    return joins.override_from_table(c, overrides, ["c_custkey", "c_nationkey"],
                                     "c_name").drop("c_nationkey")


_SEGMENTS = {"BUILDING": "House", "MACHINERY": "Engine"}


@query("scoped_override", f"""
SELECT c_custkey, CASE WHEN nullif(c_nationkey, 4) IS NULL THEN NULL WHEN c_nationkey = 3
  THEN {sql_case('c_mktsegment', _SEGMENTS)} ELSE c_mktsegment END AS segment FROM customer""")
def _scoped_override(spark, sf):
    scope = F.nullif(F.col("c_nationkey"), F.lit(4)) == 3
    return table(spark, sf, "customer").select(
        "c_custkey",
        joins.override_within(F.col("c_mktsegment"), scope, _SEGMENTS).alias("segment"))


_BIRTHS = """
SELECT nullif(cast(year(o_orderdate) AS INT), 1996) AS year, nullif(o_orderstatus, 'P') AS place,
  count(*) AS births FROM {orders} GROUP BY 1, 2"""
_DEATHS = """
SELECT nullif(cast(year(l_shipdate) AS INT), 1996) AS year, nullif(l_linestatus, 'O') AS place,
  count(*) AS deaths FROM {lineitem} GROUP BY 1, 2"""


@query("null_safe_left", f"""
SELECT b.year, b.place, births, coalesce(deaths, 0) AS deaths FROM ({_BIRTHS}) b
LEFT JOIN ({_DEATHS}) d
  ON b.year IS NOT DISTINCT FROM d.year AND b.place IS NOT DISTINCT FROM d.place""")
def _null_safe_left(spark, sf):
    joined = joins.join_on(derived(spark, sf, _BIRTHS), derived(spark, sf, _DEATHS),
                           ["year", "place"])
    return joined.withColumn("deaths", F.coalesce("deaths", F.lit(0)))


_NAMED = "SELECT nullif(c_mktsegment, 'BUILDING') AS place, c_custkey % 400 AS code FROM {customer}"
_KNOWN = "SELECT CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey % 390 END AS code FROM {orders}"


@query("unknown_names", f"""
SELECT place, code, count(*) AS n FROM ({_NAMED}) c WHERE NOT EXISTS (
  SELECT 1 FROM ({_KNOWN}) o WHERE o.code IS NOT DISTINCT FROM c.code) GROUP BY ALL""")
def _unknown_names(spark, sf):
    return joins.unknown_names(derived(spark, sf, _NAMED), derived(spark, sf, _KNOWN), "code",
                               ["place", "code"])


_DAILY = """
SELECT DISTINCT cast(year(o_orderdate) AS INT) AS event_year, cast(o_orderdate AS DATE) AS event_date
FROM {orders}"""


@query("left_join_many", f"""
WITH d AS ({_DAILY}), y AS (SELECT DISTINCT event_year AS y FROM d),
  p AS (SELECT make_date(y.y, 7, 1) AS mid_year, CAST(s.e AS INTEGER) AS event_year
    FROM y, range(1900, 2100) s(e) WHERE s.e BETWEEN (SELECT min(y) FROM y) AND y.y)
SELECT p.mid_year, p.event_year, d.event_date FROM p LEFT JOIN d USING (event_year)
WHERE d.event_date < p.mid_year""")
def _left_join_many(spark, sf):
    days = derived(spark, sf, _DAILY)
    pairs = joins.natural_left_join(mid_years(days), days)
    return pairs.filter(F.col("event_date") < F.col("mid_year")).select(
        "mid_year", "event_year", "event_date")


@query("label_join", f"""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS event_date, o_orderstatus, count(*) AS n
  FROM orders GROUP BY ALL),
  l AS (SELECT DISTINCT CASE WHEN month(o_orderdate) < 7 THEN CAST(o_orderdate AS DATE) END
    AS event_date, {sql_boundary('CAST(o_orderdate AS DATE)')} AS mid_year FROM orders)
SELECT event_date, o_orderstatus, n, mid_year FROM d LEFT JOIN l USING (event_date)""")
def _label_join(spark, sf):
    days = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("event_date"), "o_orderstatus")
    daily = group_count(days, ["event_date", "o_orderstatus"])
    # the days of the second half have a label without a day, which no day meets
    labels = days.select(
        F.when(F.month("event_date") < 7, F.col("event_date")).alias("event_date"),
        next_boundary(F.col("event_date")).alias("mid_year")).distinct()
    return joins.natural_left_join(daily, labels)


@query("next_boundary", f"""
SELECT o_orderkey, {sql_boundary('CAST(o_orderdate AS DATE)')} AS mid_year FROM orders""")
def _next_boundary(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", next_boundary(F.col("o_orderdate").cast("date")).alias("mid_year"))


# Irregular boundaries of a nation: the birthdays, so to say, of its suppliers; none for every sixth nation.
_MARKS = """
SELECT nullif(s_nationkey, 5) AS nation, date_add(DATE '1995-01-01', cast((s_suppkey * 7919) % 2600 AS INT)) AS boundary,
  s_suppkey AS supplier FROM {supplier} WHERE s_nationkey % 6 <> 2"""
# A third of the events belong to one nation.
_DATED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE nullif(c_nationkey, 5) END AS nation,
  CASE WHEN o_orderkey % 50 = 1 THEN NULL ELSE cast(o_orderdate AS DATE) END AS event_date
FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""


@query("next_from_table", f"""
WITH e AS ({_DATED}), b AS (SELECT nation, CAST(boundary AS DATE) AS boundary, min(supplier) AS supplier
  FROM ({_MARKS}) m GROUP BY ALL),
  n AS (SELECT o_orderkey, min(b.boundary) AS boundary FROM e JOIN b
    ON b.nation IS NOT DISTINCT FROM e.nation AND b.boundary > e.event_date GROUP BY o_orderkey)
SELECT e.o_orderkey, e.nation, e.event_date, n.boundary, b.supplier FROM e
LEFT JOIN n ON n.o_orderkey = e.o_orderkey
LEFT JOIN b ON b.nation IS NOT DISTINCT FROM e.nation AND b.boundary = n.boundary""")
def _next_from_table(spark, sf):
    return next_from_table(derived(spark, sf, _DATED), derived(spark, sf, _MARKS), ["nation"],
                           "event_date", "boundary", carry=["supplier"])


@query("generate_years", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
SELECT make_date(y, 7, 1) AS mid_year, CAST(e AS INTEGER) AS event_year
FROM (SELECT y, unnest(range((SELECT min(y) FROM y), y + 1)) AS e FROM y) x""")
def _generate_years(spark, sf):
    return mid_years(table(spark, sf, "orders").withColumn(
        "event_date", F.col("o_orderdate").cast("date")))


@query("year_rows", """
SELECT c_custkey, CAST(unnest(range(1990 + c_nationkey, 2001 + c_nationkey)) AS INTEGER) AS year
FROM customer""")
def _year_rows(spark, sf):
    c = table(spark, sf, "customer")
    nation = F.col("c_nationkey")
    return year_rows(c, nation + 1990, nation + 2000, "year").select("c_custkey", "year")


# --- names ------------------------------------------------------------------------------

# Raw names to correct, taken from the customers: keys of the maps and other text.
_WORDS = list(PLACE_NAMES) + list(SCOPED_NAMES) + list(PROJECTED_NAMES) + ["Flores", " Jalapa "]
_DEPTS = list(DEPARTMENT_NAMES) + ["Huehuetenango", "Peten"]


def _pick(col: str, words: list[str], every: int) -> str:
    whens = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words))
    return f"CASE {col} % {every} {whens} ELSE concat(' ', concat(c_name, ' ')) END"


_NAMES = f"""
SELECT c_custkey, {_pick('c_nationkey', _DEPTS, 6)} AS department,
  {_pick('c_custkey', _WORDS, len(_WORDS) + 5)} AS municipality FROM {{customer}}"""


# The same with departments missing.
_SOME_NAMES = f"""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE department END AS department, municipality
FROM ({_NAMES}) n"""


@query("harmonise", f"""
SELECT c_custkey, department, CASE WHEN department = 'Huehuetenango'
  THEN {sql_case('m', SCOPED_NAMES)} ELSE m END AS municipality
FROM (SELECT c_custkey, {sql_case('department', DEPARTMENT_NAMES)} AS department,
  {sql_case("trim(municipality, ' ')", PLACE_NAMES)} AS m FROM ({_NAMES}) x) y""")
def _harmonise(spark, sf):
    return harmonise(derived(spark, sf, _NAMES))


def _std(x: str) -> str:
    return sql_title(f"trim(lower({sql_ascii(x)}), ' ')")


@query("standardise", f"""
SELECT c_custkey, department, CASE WHEN department = 'Huehuetenango' AND m = 'Concepcion'
  THEN 'Concepcion Huista' WHEN department IS NULL AND m = 'Concepcion' THEN NULL
  ELSE m END AS municipality
FROM (SELECT c_custkey, department, {sql_case('m', PROJECTED_NAMES)} AS m
  FROM (SELECT c_custkey, {_std('department')} AS department, {_std('municipality')} AS m
    FROM ({_SOME_NAMES}) x) y) z""")
def _standardise(spark, sf):
    named = derived(spark, sf, _SOME_NAMES)
    return standardise(map_columns(named, ["department", "municipality"], F.upper))


# The codes whose names the report replaces, written out for the SQL.
_CODES = """
  WHEN '0413' THEN 'San Andres Itzapa' WHEN '2009' THEN 'Quezaltepeque'
  WHEN '0204' THEN 'San Cristobal Acasaguastlan' WHEN '0502' THEN 'Santa Lucia Cotzumalguapa'
  WHEN '0506' THEN 'Tiquizate' WHEN '0117' THEN 'San Miguel Petapa' WHEN '0111' THEN 'San Raimundo'
  WHEN '1314' THEN 'San Rafael La Independencia' WHEN '1320' THEN 'San Sebastian Huehuetenango'
  WHEN '1326' THEN 'Santa Cruz Barillas' WHEN '2107' THEN 'Mataquescuintla' WHEN '2217' THEN 'Quezada'
  WHEN '1420' THEN 'Ixcan' WHEN '1105' THEN 'San Felipe' WHEN '0712' THEN 'San Antonio Palopo'
  WHEN '0711' THEN 'Santa Catarina Palopo' WHEN '1004' THEN 'San Bernardino'
  WHEN '1009' THEN 'San Pablo Jocopilas' WHEN '1011' THEN 'San Miguel Panan'
  WHEN '0806' THEN 'Santa Maria Chiquimula'"""
# Every place once more under a code of another department, so that the codes above occur.
_PLACES = f"""{raw.PLACES.rstrip()} UNION ALL
SELECT concat(lpad(cast(n_nationkey % 23 AS STRING), 2, '0'), lpad(cast(r_regionkey * 7 + n_nationkey % 7
  AS STRING), 2, '0')) AS code, n_name AS name FROM {{nation}}, {{region}}"""
_CODE_OF = """
SELECT c_custkey, concat(lpad(cast(c_custkey % 23 AS STRING), 2, '0'),
  lpad(cast(c_custkey % 35 AS STRING), 2, '0')) AS code FROM {customer}"""


@query("place_lookup", f"""
SELECT c_custkey, muni_id, municipality FROM ({_CODE_OF}) c LEFT JOIN (
  SELECT code AS muni_id, CASE code {_CODES} ELSE {sql_title(sql_ascii('name'))} END AS municipality
  FROM (SELECT DISTINCT code, min(name) AS name FROM ({_PLACES}) p GROUP BY code) o) q ON muni_id = code""")
def _place_lookup(spark, sf):
    raw_places = derived(spark, sf, _PLACES).groupBy("code").agg(F.min("name").alias("name"))
    places = place_names(raw_places, "code", "name")
    codes = derived(spark, sf, _CODE_OF)
    found = codes.join(places, F.col("code") == F.col("muni_id"), "left")
    return found.select("c_custkey", "muni_id", "municipality")


# --- sources and sinks ----------------------------------------------------------------------


@query("file_scan", """
SELECT 'part.parquet' AS file_name, count(*) AS n, sum(p_size)::BIGINT AS size FROM part""")
def _file_scan(spark, sf):
    files = scans.scan_files(spark, sf, "part")
    return files.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"))


_PATHS = """
SELECT c_custkey, concat('/raw 7/data/', lpad(cast(c_nationkey AS STRING), 2, '0'), ' ',
  CASE WHEN c_custkey % 2 = 0 THEN upper(n_name) ELSE 'alta verapaz' END,
  CASE WHEN c_custkey % 5 = 0 THEN ' (1)' ELSE '' END, '.xls') AS path,
  concat('births_', cast(2000 + c_custkey % 20 AS STRING), '.sav') AS name
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""
_NOISE = "(^/([^/]+/)+)|([0-9]+ )|([^a-z .])|(.xls$)"


@query("path_department", f"""
SELECT c_custkey, {sql_title(f"regexp_replace(lower(path), '{_NOISE}', '', 'g')")} AS department,
  regexp_replace(name, '[^0-9]', '', 'g') AS file_year FROM ({_PATHS}) x
WHERE NOT regexp_matches(path, '[()]')""")
def _path_department(spark, sf):
    paths = scans.without_parentheses(derived(spark, sf, _PATHS), "path")
    return paths.select("c_custkey", scans.department_of(F.col("path")).alias("department"),
                        scans.digits(F.col("name")).alias("file_year"))


_SHEETS = """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN cast(2011 + c_custkey % 5 AS STRING)
  WHEN 1 THEN concat('Hoja', cast(1 + c_custkey % 5 AS STRING)) WHEN 2 THEN 'Hombres' ELSE 'Total'
  END AS sheet FROM {customer}"""


@query("sheet_tag", f"""
SELECT c_custkey, coalesce(try_cast(sheet AS INTEGER), 2010 + try_cast(
  nullif(regexp_replace(sheet, '[^0-9]', '', 'g'), '') AS INTEGER)) AS year,
  {sql_case('sheet', scans.SHEET_SEX)} AS sex FROM ({_SHEETS}) x""")
def _sheet_tag(spark, sf):
    sheet = F.col("sheet")
    return derived(spark, sf, _SHEETS).select(
        "c_custkey", scans.sheet_year(sheet).alias("year"), scans.sheet_sex(sheet).alias("sex"))


_GRID = """
SELECT cast(c_nationkey AS STRING) AS department, cast(2010 + c_nationkey % 6 AS STRING) AS sheet,
  cast(c_custkey + 1 AS INT) AS row_idx,
  CASE WHEN c_custkey % 7 = 0 THEN '?' ELSE c_mktsegment END AS value FROM {customer}"""
_SKIPS = """
SELECT DISTINCT cast(s_nationkey AS STRING) AS department, cast(2010 + s_nationkey % 6 AS STRING)
  AS sheet, cast(10 + s_nationkey AS INT) AS skip FROM {supplier} WHERE s_nationkey % 2 = 0"""


@query("skip_rows", f"""
SELECT g.department, g.sheet, CAST(row_idx - coalesce(skip, 3) AS INTEGER) AS row_idx,
  nullif(value, '?') AS value
FROM ({_GRID}) g LEFT JOIN ({_SKIPS}) s ON g.department = s.department AND g.sheet = s.sheet
WHERE row_idx > coalesce(skip, 3)""")
def _skip_rows(spark, sf):
    cells = scans.skip_override(derived(spark, sf, _GRID), derived(spark, sf, _SKIPS), 3)
    return cells.withColumn("value", scans.null_marker(F.col("value"), "?"))


@query("records_stack", """
SELECT '1' AS file_year, CAST(c_custkey AS VARCHAR) AS codigo, c_mktsegment AS sexo,
  NULL::VARCHAR AS extra FROM customer
UNION ALL SELECT '2', CAST(s_suppkey AS VARCHAR), NULL, s_name FROM supplier""")
def _records_stack(spark, sf):
    first = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Código"), F.col("c_mktsegment").alias("SEXO"))
    second = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("CODIGO"), F.col("s_name").alias("Extra"))
    return scans.stack_records({"1": first, "2": second})


# Yearly record files: columns in another order in odd years, one of them missing in every fourth, with
# accents in the names of even years.
_RECORDS = """
SELECT cast(o_orderkey AS STRING) AS codigo, o_orderstatus AS ano, cast(o_custkey AS STRING) AS sexo,
  cast(year(o_orderdate) AS INT) AS y FROM {orders}"""


def _write_years(rows, folder: str, file_format: str) -> None:
    """Files ``births_<year>_<letters>``: the files of one partitioned write, moved to their names."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "years")
    rows.write.format(file_format).option("header", True).partitionBy("y").save(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop(folder))
    for year in files.globStatus(hadoop(f"{path}/y=*")):
        for i, part in enumerate(sorted(str(f.getPath()) for f in files.globStatus(hadoop(f"{year.getPath()}/part-*")))):
            letters = str(i).translate(str.maketrans("0123456789", "abcdefghij"))  # the digits are the year
            name = f"births_{year.getPath().getName()[2:]}_{letters}.{file_format}"
            files.rename(hadoop(part), hadoop(f"{folder}/{name}"))


@query("records_scan", f"""
SELECT CAST(y AS VARCHAR) AS file_year, format, codigo, ano, CASE WHEN y % 4 <> 0 THEN sexo END AS sexo
FROM ({_RECORDS}) r, (VALUES ('csv'), ('parquet')) f(format)""")
def _records_scan(spark, sf):
    rows = derived(spark, sf, _RECORDS)
    tables = []
    for file_format in ("csv", "parquet"):
        folder = fresh_path(spark, "records")
        for years, names in (
            (F.col("y") % 4 == 0, {"Código": "codigo", "año": "ano"}),
            (F.col("y") % 4 == 2, {"Código": "codigo", "año": "ano", "SEXO": "sexo"}),
            (F.col("y") % 2 == 1, {"ano": "ano", "codigo": "codigo", "SEXO": "sexo"}),
        ):
            kind = rows.filter(years).repartition("y", F.col("codigo").try_cast("bigint") % 3)
            _write_years(kind.select("y", *[F.col(c).alias(n) for n, c in names.items()]), folder, file_format)
        options = {"header": "true"} if file_format == "csv" else {}
        read = scans.read_records(spark, folder, "births", file_format, **options)
        tables.append(read.withColumn("format", F.lit(file_format)))
    return tables[0].unionByName(tables[1])


@query("file_schemas", f"""
SELECT CASE WHEN y % 2 = 1 THEN 3 WHEN y % 4 = 2 THEN 3 ELSE 2 END AS n_columns, y % 2 = 1 AS plain_names,
  count(DISTINCT y) AS n_years FROM ({_RECORDS}) r GROUP BY ALL""")
def _file_schemas(spark, sf):
    rows, folder = derived(spark, sf, _RECORDS), fresh_path(spark, "records")
    for years, names in (
        (F.col("y") % 4 == 0, ["Código", "año"]),
        (F.col("y") % 4 == 2, ["Código", "año", "SEXO"]),
        (F.col("y") % 2 == 1, ["ano", "codigo", "SEXO"]),
    ):
        kind = rows.filter(years).repartition("y", F.col("codigo").try_cast("bigint") % 3)
        taken = {"Código": "codigo", "año": "ano", "SEXO": "sexo"}
        _write_years(kind.select("y", *[F.col(taken.get(n, n)).alias(n) for n in names]), folder, "parquet")
    found = scans.file_schemas(spark, folder, "births")
    names = F.transform(F.from_json("schema", "array<array<string>>"), lambda x: x[0])
    year = F.explode(F.array_distinct(F.transform("files", lambda f: F.regexp_extract(f, "births_([0-9]+)_", 1))))
    return found.select(F.size(names).alias("n_columns"), F.array_contains(names, "ano").alias("plain_names"),
                        year.alias("year")).groupBy("n_columns", "plain_names").agg(
        F.count(F.lit(1)).alias("n_years"))


@query("codebook", """
SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS file_year, v.variable, v.code, v.label
FROM orders, LATERAL (VALUES ('priority', left(o_orderpriority, 1), substr(o_orderpriority, 3)),
  ('status', o_orderstatus, lower(o_orderstatus))) v(variable, code, label)""")
def _codebook(spark, sf):
    coded = table(spark, sf, "orders").select(
        F.year("o_orderdate").cast("string").alias("file_year"),
        F.substring("o_orderpriority", 1, 1).alias("p"),
        F.substr(F.col("o_orderpriority"), F.lit(3)).alias("p_label"),
        F.col("o_orderstatus").alias("s"), F.lower("o_orderstatus").alias("s_label"))
    return scans.codebook(coded, {"priority": ("p", "p_label"), "status": ("s", "s_label")})


_SNAPSHOT = """
SELECT cast(year(l_shipdate) AS INT) AS year, l_suppkey AS place, l_linestatus AS sex,
  l_linenumber AS age, sum(l_quantity) AS population FROM {lineitem} GROUP BY 1, 2, 3, 4"""


@query("parquet_roundtrip", _SNAPSHOT)
def _parquet_roundtrip(spark, sf):
    df = derived(spark, sf, _SNAPSHOT)
    path = fresh_path(spark, "snapshot")
    snapshots.write_snapshot(df, path)
    return snapshots.read_snapshot(spark, path, df.schema)


@query("csv_roundtrip", """
SELECT l_suppkey AS place, nullif(l_linestatus, 'O') AS sex, sum(l_quantity) AS population
FROM lineitem GROUP BY 1, 2""")
def _csv_roundtrip(spark, sf):
    sex = F.nullif(F.col("l_linestatus"), F.lit("O")).alias("sex")
    df = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("place"), sex).agg(
        F.sum("l_quantity").alias("population"))
    path = fresh_path(spark, "report")
    snapshots.write_csv(df, path)
    return snapshots.read_csv(spark, path, df.schema)
