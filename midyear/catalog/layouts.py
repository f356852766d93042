"""Workbook layouts: cell tables derived from the given tables, read back to long form.

Twenty suppliers share a workbook; its department is the region of the workbook number.
Every cell of the used range is built, so the number of cells grows with the suppliers.
The SQL counterpart never sees the cells: it takes the long form from the line items.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from midyear.catalog.registry import query, table
from midyear.catalog.scalars import sql_title
from midyear.functions.text import pad_left
from midyear.plans import layouts
from midyear.sources import scans
from midyear.sources.shared import fresh_path

PLACES = 20
REGIONS = ["Africa", "America", "Asia", "Europe", "Middle East"]
LATE = ["Africa", "Asia"]
OPTIONS_2011 = {"late": LATE, "blank_places": {"Asia": "Nueva Asia"}}

# All years from the first to the last of the line items, and all ages up to the highest.
YEARS = """(SELECT CAST(unnest(range(min(year(l_shipdate)), max(year(l_shipdate)) + 1)) AS INTEGER) AS y
  FROM lineitem)"""
AGES = "(SELECT CAST(unnest(range(1, max(l_linenumber) + 1)) AS INTEGER) AS a FROM lineitem)"
FIRST = "(SELECT CAST(min(year(l_shipdate)) AS INTEGER) FROM lineitem)"

# Quantity per supplier, year, age and sex; a combination without line items is NULL.
FACTS = f"""
SELECT s_suppkey, s_name, CAST(floor(s_suppkey / {PLACES}) AS INTEGER) AS file_no, y, a, st, qty
FROM supplier, {YEARS} ys, {AGES} ages,
  (SELECT unnest(['O', 'F']) AS st) statuses
LEFT JOIN (SELECT l_suppkey, year(l_shipdate) AS ly, l_linenumber, l_linestatus,
    sum(l_quantity) AS qty FROM lineitem GROUP BY ALL) q
  ON l_suppkey = s_suppkey AND ly = y AND l_linenumber = a AND l_linestatus = st"""

_DEPARTMENT = f"""{sql_title("lower(r_name)")}"""
_REGION = "region ON r_regionkey = file_no % 5"


def _suppliers(spark, sf):
    """Suppliers with workbook number, position and department."""
    key = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", F.floor(key / PLACES).cast("int").alias("file_no"),
        (key % PLACES).cast("int").alias("pos"))
    region = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("int").alias("__r"), F.lower("r_name").alias("region"))
    return rows.join(region, F.col("file_no") % 5 == F.col("__r")).drop("__r")


def extent(spark, sf) -> tuple[int, int, int]:
    """First and last year and highest age of the line items."""
    row = table(spark, sf, "lineitem").agg(
        F.min(F.year("l_shipdate")), F.max(F.year("l_shipdate")), F.max("l_linenumber")).first()
    return tuple(map(int, row))


def _quantities(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("y"),
        F.col("l_linenumber").alias("a"), F.col("l_linestatus").alias("st"),
    ).agg(F.sum("l_quantity").alias("qty"))


def _dense(spark, sf, first, last, ages):
    """Suppliers by year and age with the quantities of both sexes and their sum."""
    grid = _suppliers(spark, sf).withColumn(
        "y", F.explode(F.sequence(F.lit(first), F.lit(last)))
    ).withColumn("a", F.explode(F.sequence(F.lit(1), F.lit(ages))))
    wide = _quantities(spark, sf).groupBy("s_suppkey", "y", "a").agg(
        F.sum(F.when(F.col("st") == "O", F.col("qty"))).alias("male"),
        F.sum(F.when(F.col("st") == "F", F.col("qty"))).alias("female"),
        F.sum("qty").alias("total"))
    return grid.join(wide, ["s_suppkey", "y", "a"], "left")


def _text(c):
    return F.coalesce(c.cast("bigint").cast("string"), F.lit("?"))


def _file(prefix: str):
    # Never cut: workbooks from number 100 on would share the name of another one.
    number = pad_left((F.col("file_no") + 1).cast("string"))
    return F.concat(F.lit(prefix), number, F.lit(" "), F.col("region"), F.lit(".xls"))


def _cells(df, row, col, value):
    """A block of cells: expressions for row, column and text."""
    return df.select("file", "sheet", row.cast("int").alias("row_idx"),
                     col.cast("int").alias("col_idx"), value.cast("string").alias("value"))


def workbook(cells):
    """The cells as a workbook export: written once, then read like any cell table."""
    spark = cells.sparkSession
    path = fresh_path(spark, "workbook")
    cells.write.parquet(path)
    return scans.read_cells(spark, path)


# --- 2000-2010 ------------------------------------------------------------------------


def cells_2000(spark, sf):
    start, last, n_ages = extent(spark, sf)
    # Rows of a year: its marker, the ages, and one row with the age 100, which no year keeps.
    block = n_ages + 2
    suppliers = _suppliers(spark, sf).withColumn("file", _file("/raw/2000-2010/")).withColumn(
        "sheet", F.lit("Población TOTAL"))
    dense = _dense(spark, sf, start, last, n_ages).withColumn("file", _file("/raw/2000-2010/")).withColumn(
        "sheet", F.lit("Población TOTAL"))
    lit, col = F.lit, F.col
    files = suppliers.select("file", "sheet", "file_no").distinct()
    # Odd workbooks have no year in the first header cell.
    first = F.when(col("file_no") % 2 == 0, lit(str(start))).otherwise("Edad")
    header = _cells(files, lit(1), lit(1), first).unionByName(
        _cells(files, lit(1), lit(2), lit("Total")))
    zero = _cells(files, lit(2), lit(2), lit("0"))
    names = _cells(suppliers, lit(2), 5 + 3 * col("pos"),
                   F.concat(lit("San José "), col("s_name")))
    years = files.withColumn("y", F.explode(F.sequence(lit(start), lit(last))))
    top = 3 + (col("y") - start) * block
    marks = _cells(years, top, lit(1), F.when(col("y") == start, lit("Edad")).otherwise(
        col("y").cast("string")))
    ages = years.withColumn("a", F.explode(F.sequence(lit(1), lit(n_ages + 1))))
    age_text = F.when(col("a") == n_ages, F.concat(col("a").cast("string"), lit("+"))).when(
        col("a") > n_ages, lit("100")).otherwise(F.concat(col("a").cast("string"), lit("'")))
    labels = _cells(ages, top + col("a"), lit(1), age_text)
    wide = dense.select("*", F.posexplode(F.array("total", "male", "female")).alias("m", "v"))
    body = _cells(wide, top + col("a"), 5 + 3 * col("pos") + col("m"), _text(col("v")))
    marker_cells = _cells(
        years.withColumn("m", F.explode(F.sequence(lit(2), lit(4)))), top, col("m"),
        lit(None).cast("string"))
    out = header
    for part in (zero, names, marks, labels, body, marker_cells):
        out = out.unionByName(part)
    return out


LONG_2000 = f"""
SELECT y AS year, {_DEPARTMENT} AS department, 'San Jose ' || s_name AS municipality,
  CASE st WHEN 'O' THEN 'male' ELSE 'female' END AS sex, a AS age, qty AS population
FROM ({FACTS}) f JOIN {_REGION}"""


@query("layout_2000", LONG_2000)
def _layout_2000(spark, sf):
    return layouts.layout_2000(workbook(cells_2000(spark, sf)))


@query("year_sections", f"""
SELECT file_no, y AS year, a AS age, count(*) AS n FROM (SELECT DISTINCT
  CAST(floor(s_suppkey / {PLACES}) AS INTEGER) AS file_no FROM supplier) s,
  {YEARS} ys, {AGES} ages GROUP BY ALL""")
def _year_sections(spark, sf):
    rows = layouts.year_sections_2000(workbook(cells_2000(spark, sf)))
    number = F.regexp_extract("file", "/([0-9]+) ", 1).cast("int") - 1
    return rows.groupBy(number.alias("file_no"), "year", "age").agg(
        F.count(F.lit(1)).alias("n"))


@query("place_columns", f"""
SELECT file_no, 'san_jose_' || lower(s_name) AS place, measure, 5 + 3 * pos + m AS col_idx FROM (
  SELECT s_name, CAST(floor(s_suppkey / {PLACES}) AS INTEGER) AS file_no,
    CAST(s_suppkey % {PLACES} AS INTEGER) AS pos FROM supplier) s,
  (VALUES (0, 'total'), (1, 'masculino'), (2, 'femenino')) v(m, measure)
UNION ALL SELECT file_no, 'total', measure, 2 + m FROM (
  SELECT DISTINCT CAST(floor(s_suppkey / {PLACES}) AS INTEGER) AS file_no FROM supplier) s,
  (VALUES (0, 'total'), (1, 'masculino'), (2, 'femenino')) v(m, measure)""")
def _place_columns(spark, sf):
    columns = layouts.place_columns_2000(workbook(cells_2000(spark, sf)))
    number = F.regexp_extract("file", "/([0-9]+) ", 1).cast("int") - 1
    return columns.select(number.alias("file_no"), "place", "measure", "col_idx")


# --- 2011-2015 ------------------------------------------------------------------------


def cells_2011(spark, sf):
    """The years as sheets from 2011 on; every third workbook numbers its sheets instead,
    and every workbook with a copy in parentheses has it dropped."""
    start, last, n_ages = extent(spark, sf)
    lit, col = F.lit, F.col
    year = F.concat(lit(""), (col("y") - start + 2011).cast("string"))
    sheet = F.when(col("file_no") % 3 == 2,
                   F.concat(lit("Hoja"), (col("y") - start + 1).cast("string"))).otherwise(year)
    late = F.initcap("region").isin(LATE)
    skip = F.when(late & (sheet == "2012"), 4).when(late & (sheet == "2015"), 5).otherwise(3)

    def sheets(df):
        return df.withColumns({"file": _file("/raw/2011-2015/"), "sheet": sheet, "skip": skip})

    suppliers = sheets(_suppliers(spark, sf).withColumn(
        "y", F.explode(F.sequence(lit(start), lit(last)))))
    dense = sheets(_dense(spark, sf, start, last, n_ages))
    tops = suppliers.select("file", "sheet", "skip").distinct()
    titles = _cells(tops.withColumn("r", F.explode(F.sequence(lit(1), col("skip")))),
                    col("r"), lit(1), lit("Proyecciones"))
    header = _cells(tops, col("skip") + 1, lit(1), lit("Sexo"))
    # The first place of a workbook of region Asia has no header.
    name = F.when((col("region") == "asia") & (col("pos") == 0), None).otherwise(
        F.concat(lit("San José "), col("s_name")))
    names = _cells(suppliers, col("skip") + 1, col("pos") + 2, name)
    block = n_ages + 1
    halves = tops.withColumn("h", F.explode(F.array(lit(0), lit(1))))
    top = col("skip") + 2 + col("h") * block
    heads = _cells(halves, top, lit(1), F.when(col("h") == 0, "Hombres").otherwise("MUJERES"))
    labels = _cells(halves.withColumn("a", F.explode(F.sequence(lit(1), lit(n_ages)))),
                    top + col("a"), lit(1), F.concat(col("a").cast("string"), lit("+")))
    both = dense.select("*", F.posexplode(F.array("male", "female")).alias("h", "v"))
    body = _cells(both, top + col("a"), col("pos") + 2, _text(col("v")))
    blank = _cells(tops, col("skip") + 2 + 2 * block, lit(1), lit(None).cast("string"))
    out = titles
    for part in (header, names, heads, labels, body, blank):
        out = out.unionByName(part)
    copy = out.withColumn("file", F.replace(col("file"), lit(".xls"), lit(" (1).xls")))
    return out.unionByName(copy)


LONG_2011 = f"""
SELECT y - {FIRST} + 2011 AS year, {_DEPARTMENT} AS department,
  CASE WHEN r_name = 'ASIA' AND s_suppkey % {PLACES} = 0 THEN 'Nueva Asia'
    ELSE 'San Jose ' || s_name END AS municipality,
  CASE st WHEN 'O' THEN 'male' ELSE 'female' END AS sex, a AS age, qty AS population
FROM ({FACTS}) f JOIN {_REGION}"""


@query("layout_2011", LONG_2011)
def _layout_2011(spark, sf):
    return layouts.layout_2011(workbook(cells_2011(spark, sf)), **OPTIONS_2011)


# --- 2016-2020 ------------------------------------------------------------------------

SEXES = [("Total", "total"), ("Hombres", "male"), ("Mujeres", "female")]


def cells_2016(spark, sf):
    """One workbook with three sheets; workbook numbers are department blocks.

    Columns: label, ``Total`` over the years from 2016 on, a group with a digit in its name over
    the same years, and a repeated total; both extra groups are dropped on reading.
    """
    start, last, n_ages = extent(spark, sf)
    n = last - start + 1
    lit, col = F.lit, F.col
    block = PLACES + 3
    sums = _dense(spark, sf, start, last, n_ages).groupBy(
        "s_suppkey", "s_name", "file_no", "pos", "region", "y").agg(
        F.sum("total").alias("total"), F.sum("male").alias("male"),
        F.sum("female").alias("female"))
    years = F.sequence(lit(0), lit(n - 1))
    book = spark.range(1).select(
        lit("/raw/2016-2020.xlsx").alias("file"),
        F.explode(F.array(*[lit(s) for s, _ in SEXES])).alias("sheet"))

    def on_sheets(df):
        return df.select("*", lit("/raw/2016-2020.xlsx").alias("file"),
                         F.explode(F.array(*[lit(s) for s, _ in SEXES])).alias("sheet"))

    titles = _cells(book.withColumn("r", F.explode(F.sequence(lit(1), lit(3)))), col("r"),
                    lit(1), lit("Proyecciones"))
    spans = F.array(
        F.struct(lit(1).alias("c"), lit("Departamento y\nMunicipio").alias("t")),
        F.struct(lit(2).alias("c"), lit("Total").alias("t")),
        F.struct(lit(2 + n).alias("c"), lit("Menores de 1 año").alias("t")),
        F.struct(lit(2 + 2 * n).alias("c"), lit("Total").alias("t")))
    filled = book.select("*", F.inline(spans))
    header = _cells(filled, lit(4), col("c"), col("t")).unionByName(
        _cells(book.withColumn("c", F.explode(F.array(*[lit(c) for c in range(3, 2 + 2 * n) if c != 2 + n]))),
               lit(4), col("c"), lit(None).cast("string")))
    year_row = book.withColumn("i", F.explode(years)).withColumn(
        "g", F.explode(F.array(lit(2), lit(2 + n))))
    detail = _cells(year_row, lit(5), col("g") + col("i"), (col("i") + 2016).cast("string"))
    detail = detail.unionByName(_cells(book, lit(5), lit(2 + 2 * n), lit("2016"))).unionByName(
        _cells(book, lit(5), lit(1), lit(None).cast("string")))
    suppliers = _suppliers(spark, sf)
    depts = on_sheets(suppliers.select("file_no", "region").distinct())
    top = 6 + col("file_no") * block
    heads = _cells(depts, top, lit(1), lit(None)).unionByName(
        _cells(depts, top + 1, lit(1), F.upper("region"))).unionByName(
        _cells(depts, top + 2 + PLACES, lit(1), lit(None)))
    # A workbook with fewer places leaves no label cell: blank rows are cells too.
    gaps = _cells(
        depts.join(suppliers.groupBy("file_no").agg(F.max("pos").alias("m")), "file_no")
        .withColumn("p", F.explode_outer(F.when(col("m") < PLACES - 1, F.sequence(
            col("m") + 1, lit(PLACES - 1))))).filter(col("p").isNotNull()),
        top + 2 + col("p"), lit(1), lit(None))
    labels = _cells(on_sheets(suppliers), top + 2 + col("pos"), lit(1),
                    F.concat(lit(" San José "), col("s_name")))
    data = on_sheets(sums)
    value = F.when(col("sheet") == "Total", col("total")).when(
        col("sheet") == "Hombres", col("male")).otherwise(col("female"))
    text = F.coalesce(value.cast("bigint").cast("string"), lit("-"))
    data = data.withColumn("text", text).withColumn("g", F.explode(F.array(lit(2), lit(2 + n))))
    body = _cells(data, top + 2 + col("pos"), col("g") + col("y") - start, col("text"))
    repeated = _cells(data.filter((col("y") == start) & (col("g") == 2)),
                      top + 2 + col("pos"), lit(2 + 2 * n), col("text"))
    out = titles
    for part in (header, detail, heads, gaps, labels, body, repeated):
        out = out.unionByName(part)
    return out


LONG_2016 = f"""
SELECT v.sex, 'total' AS type, y - {FIRST} + 2016 AS year, upper(r_name) AS department,
  ' San José ' || s_name AS municipality,
  sum(CASE WHEN v.st IS NULL OR v.st = f.st THEN qty END) AS population
FROM ({FACTS}) f JOIN {_REGION},
  (VALUES ('all', NULL), ('male', 'O'), ('female', 'F')) v(sex, st) GROUP BY ALL"""


@query("layout_2016", LONG_2016)
def _layout_2016(spark, sf):
    return layouts.layout_2016(workbook(cells_2016(spark, sf)))
