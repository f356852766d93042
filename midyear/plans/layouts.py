"""Three generations of workbook layouts, from cell table to long table.

Contract of a cell table: one row per cell of the used range (blank cells hold NULL),
``row_idx`` and ``col_idx`` count from 1, and the first column holds the row labels.

The cells are read twice: the first pass writes the frame of the sheets (label column and
header rows, a small part of the cells) to the shared folder, the second one reads the
measures.  Only the label column goes through the order-dependent operators; its result is
joined to the measure cells by row, and the header by column.  The header is repeated once
per chunk of rows before that join, so one large sheet is not one join key.

Each layout runs the job that writes its frame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from midyear.functions.numbers import safe_double, safe_int
from midyear.functions.recode import recode
from midyear.functions.text import header_name, key_to_place
from midyear.operators.ordered import numbered, place, previous, sections
from midyear.operators.shape import split_key
from midyear.operators.totals import with_group_min
from midyear.sources.scans import (
    department_of, null_marker, sheet_sex, sheet_year, skip_rows, without_parentheses,
)
from midyear.sources.shared import cut_lineage

SHEET = ["file", "sheet"]
# Rows of a sheet that share a copy of its header in a join.
CHUNK_ROWS = 65_536
POPULATION = ["year", "department", "municipality", "sex", "age", "population"]
AGGREGATE = ["sex", "type", "year", "department", "municipality", "population"]

# Null markers, measure order and words of the three layouts.
NULL_2000, NULL_2011, NULL_2016 = "?", "?", "-"
MEASURES_2000 = ["Total", "Masculino", "Femenino"]
SEX_2000 = {"masculino": "male", "femenino": "female"}
SEX_2011 = {"hombres": "male", "mujeres": "female"}
SKIP_2011, SKIP_2016 = 3, 0
# Departments whose sheets "2012" and "2015" start lower.
LATE_DEPARTMENTS = [
    "Totonicapan", "Suchitepequez", "Retalhuleu", "Quiche", "Alta Verapaz",
    "Peten", "Jutiapa", " Jalapa", "Chiquimula", "Izabal", "Santa Rosa",
]
LATE_SHEETS = {"2012": 4, "2015": 5}
SKIPS_2016 = {"Total": 3, "Hombres": 3, "Mujeres": 3}
# Fixed value: the place under a blank header.
BLANK_PLACES = {"Santa Rosa": "Nueva Santa Rosa"}
# Patterns of age text and of spanning headers.
AGE_MARKS = "['+]"
BLANK_HEADER = "(?i)x_"
HEADER_GAPS = "[ y\n]+"
ODD_HEADER = "_[0-9]_"


def _frame(cells: DataFrame, header_rows: int) -> DataFrame:
    """Label column and header rows of every sheet, written once (runs a job)."""
    return cut_lineage(
        cells.filter((F.col("col_idx") == 1) | (F.col("row_idx") <= header_rows))
    )


def _labels(cells: DataFrame, into: str) -> DataFrame:
    return cells.filter(F.col("col_idx") == 1).select(
        *SHEET, "row_idx", F.col("value").alias(into)
    )


def _header(cells: DataFrame, row: int, into: str) -> DataFrame:
    return cells.filter(F.col("row_idx") == row).select(
        *SHEET, "col_idx", F.col("value").alias(into)
    )


def _join_cells(cells: DataFrame, frame: DataFrame, rows: DataFrame,
                columns: DataFrame) -> DataFrame:
    """Measure cells with the attributes of their row and of their column."""
    chunk = F.floor(F.col("row_idx") / CHUNK_ROWS).alias("__chunk")
    chunks = frame.filter(F.col("col_idx") == 1).select(*SHEET, chunk).distinct()
    spread = columns.join(chunks, SHEET)
    measured = cells.filter(F.col("col_idx") > 1).select(
        *SHEET, "row_idx", "col_idx", "value", chunk
    )
    return measured.join(spread, [*SHEET, "__chunk", "col_idx"]).join(
        rows, [*SHEET, "row_idx"]
    )


def age_of(text: Column) -> Column:
    """Age text such as ``80+`` to INT; any other text is NULL."""
    return safe_int(F.regexp_replace(text, AGE_MARKS, ""))


def place_columns_2000(cells: DataFrame) -> DataFrame:
    """``(file, sheet, col_idx, place, measure)`` of the first layout.

    The distinct names of the second row, in order, own three columns each from column 5
    on; columns 2 to 4 belong to the header of column 2.
    """
    names = _header(cells, 2, "place").filter(
        F.col("place").isNotNull() & (F.col("place") != "0")
    )
    names = names.groupBy(*SHEET, "place").agg(F.min("col_idx").alias("col_idx"))
    names = numbered(names, SHEET, "col_idx", "place_no").drop("col_idx")
    whole = _header(cells, 1, "place").filter(F.col("col_idx") == 2).select(
        *SHEET, "place", F.lit(0).cast("bigint").alias("place_no")
    )
    measures = F.array(*[F.lit(m.lower()) for m in MEASURES_2000])
    return names.unionByName(whole).select(
        *SHEET,
        header_name(F.col("place")).alias("place"),
        "place_no",
        F.posexplode(measures).alias("__m", "measure"),
    ).select(
        *SHEET, "place", "measure",
        (F.lit(2) + 3 * F.col("place_no") + F.col("__m")).cast("int").alias("col_idx"),
    )


def age_sections(ages: DataFrame, group: list[str], order: str, **options) -> DataFrame:
    """Years and ages that share the column ``age``: a value over 100 opens the section of
    that year.  A leading section without a year gets the year before the earliest one of
    its group."""
    rows = sections(ages, group, order, F.col("age") > 100, {"year": F.col("age")}, **options)
    rows = rows.filter(F.col("age") < 100)
    earliest = F.when(F.col("year") > 100, F.col("year"))
    rows = with_group_min(rows, group, earliest, "__earliest")
    year = F.when(F.col("year") < 100, F.col("__earliest") - 1).otherwise(F.col("year"))
    return rows.withColumn("year", year).drop("__earliest")


def year_sections_2000(cells: DataFrame) -> DataFrame:
    """``(file, sheet, row_idx, year, age)`` of the first layout; the label of row 3 is the
    header of the first column."""
    first = _header(cells, 1, "first_year").filter(F.col("col_idx") == 1).drop("col_idx")
    labels = _labels(cells, "label").filter(F.col("row_idx") > 2).join(first, SHEET, "left")
    text = F.when(F.col("row_idx") == 3, F.col("first_year")).otherwise(F.col("label"))
    ages = labels.select(*SHEET, "row_idx", age_of(text).alias("age")).filter(
        F.col("age").isNotNull()
    )
    return age_sections(ages, SHEET, "row_idx").select(*SHEET, "row_idx", "year", "age")


def layout_2000(cells: DataFrame) -> DataFrame:
    """Layout of 2000-2010: names in row 2, three columns per place, years inside the age
    column."""
    cells = cells.withColumn("value", null_marker(F.col("value"), NULL_2000))
    frame = _frame(cells, 2)
    columns = place_columns_2000(frame).filter(
        (F.col("measure") != "total") & (F.col("place") != "total")
    )
    columns = columns.select(
        *SHEET,
        "col_idx",
        department_of(F.col("file")).alias("department"),
        key_to_place(F.col("place")).alias("municipality"),
        recode(F.col("measure"), SEX_2000).alias("sex"),
    )
    long = _join_cells(cells, frame, year_sections_2000(frame), columns)
    return long.withColumn("population", safe_double(F.col("value"))).select(*POPULATION)


def skip_2011(department: Column, sheet: Column, late: list[str] | None = None) -> Column:
    """Leading rows of a sheet; the raw sheet name is tested, and before the department, which is costlier."""
    is_late = department.isin(LATE_DEPARTMENTS if late is None else late)
    out = F.lit(SKIP_2011)
    for name, skip in LATE_SHEETS.items():
        out = F.when((sheet == name) & is_late, F.lit(skip)).otherwise(out)
    return out


def fill_blank_place(department: Column, place: Column,
                     names: Mapping[str, str] = BLANK_PLACES) -> Column:
    """Name for a column without header (NULL, or a made-up name starting with X)."""
    blank = place.isNull() | place.rlike("^X")
    return F.when(blank, recode(department, names, default=place)).otherwise(place)


def layout_2011(cells: DataFrame, late: list[str] | None = None,
                blank_places: Mapping[str, str] = BLANK_PLACES) -> DataFrame:
    """Layout of 2011-2015: one sheet per year, sex headings inside the age column."""
    cells = without_parentheses(cells, "file")
    cells = cells.withColumn("value", null_marker(F.col("value"), NULL_2011))
    cells = skip_rows(cells, skip_2011(department_of(F.col("file")), F.col("sheet"), late))
    department = department_of(F.col("file"))
    place = key_to_place(header_name(F.col("place")))
    frame = _frame(cells, 1)
    columns = _header(frame, 1, "place").filter(F.col("col_idx") > 1).select(
        *SHEET,
        "col_idx",
        sheet_year(F.col("sheet")).alias("year"),
        department.alias("department"),
        fill_blank_place(department, place, blank_places).alias("municipality"),
    )
    labels = _labels(frame, "label").filter(
        (F.col("row_idx") > 1) & F.col("label").isNotNull()
    ).withColumn("age", age_of(F.col("label")))
    rows = sections(
        labels, SHEET, "row_idx", F.col("age").isNull(), {"heading": F.col("label")}
    ).filter(F.col("age").isNotNull())
    sex = recode(F.lower("heading"), SEX_2011).alias("sex")
    long = _join_cells(cells, frame, rows.select(*SHEET, "row_idx", sex, "age"), columns)
    return long.withColumn("population", safe_double(F.col("value"))).select(*POPULATION)


def spanning_names(header: DataFrame, group: list[str], order: str, label: str,
                   detail: str, **options) -> DataFrame:
    """Column names from a spanning header: the label is filled to the right over blank
    cells and joined with the detail row below it."""
    blank = F.col(label).isNull() | F.col(label).rlike(BLANK_HEADER)
    filled = sections(header, group, order, ~blank, {"span": F.when(~blank, F.col(label))},
                      **options)
    span = F.regexp_replace(F.lower("span"), HEADER_GAPS, "_")
    return filled.select(
        *group, order,
        F.concat(span, F.lit("_"), F.coalesce(F.col(detail), F.lit(""))).alias("name"),
    )


def distinct_columns(names: DataFrame, group: list[str], order: str) -> DataFrame:
    """First column of each name, without names that hold a single digit between ``_``."""
    first = names.groupBy(*group, "name").agg(F.min(order).alias(order))
    return first.filter(~F.col("name").rlike(ODD_HEADER))


def department_blocks(labels: DataFrame, group: list[str], order: str, label: str,
                      **options) -> DataFrame:
    """Rows of blocks that a blank row separates, headed by their department row.

    The head row is the block total and is dropped.
    """
    labels = previous(place(labels, group, order, **options), group, order, label, "__previous")
    starts = F.col("__previous").isNull() & F.col(label).isNotNull()
    blocks = sections(labels, group, order, starts, {"department": F.col(label)},
                      section="block")
    return blocks.filter(
        F.col(label).isNotNull() & (F.col(order) > F.col("section_start"))
    ).drop("__previous", "section_start")


def layout_2016(cells: DataFrame, skip: int = SKIP_2016) -> DataFrame:
    """Layout of 2016-2020: spanning header over a year row, department blocks below."""
    cells = skip_rows(cells, recode(F.col("sheet"), SKIPS_2016, default=F.lit(skip)))
    cells = cells.withColumn("value", null_marker(F.col("value"), NULL_2016))
    frame = _frame(cells, 2)
    header = _header(frame, 1, "label").join(
        _header(frame, 2, "detail"), [*SHEET, "col_idx"], "left"
    )
    columns = distinct_columns(spanning_names(header, SHEET, "col_idx", "label", "detail"),
                               SHEET, "col_idx").filter(F.col("col_idx") > 1)
    columns = split_key(columns, "name", {"type": "string", "year": "int"}, r"[^\p{L}\p{N}]+")
    labels = _labels(frame, "municipality").filter(F.col("row_idx") > 1)
    columns = columns.withColumn("sex", sheet_sex(F.col("sheet")))
    rows = department_blocks(labels, SHEET, "row_idx", "municipality").drop("block")
    long = _join_cells(cells, frame, rows, columns)
    return long.withColumn("population", safe_double(F.col("value"))).select(*AGGREGATE)
