"""Multi-file scans with provenance columns.

A workbook is read as a *cell table*: one row per cell of the used range, with
``file, sheet, row_idx, col_idx, value`` (1-based indexes, blank cells NULL).
"""

from __future__ import annotations

import csv
import json
from collections.abc import Mapping, Sequence
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from midyear.functions.numbers import safe_int
from midyear.functions.recode import recode
from midyear.functions.text import ascii_text, title_case
from midyear.operators.joins import natural_left_join, one_per_key
from midyear.operators.shape import union_by_name

CELL_COLUMNS = ["file", "sheet", "row_idx", "col_idx", "value"]


def scan_files(
    spark: SparkSession, path: str, pattern: str | None = None, file_format: str = "parquet",
    **options: str,
) -> DataFrame:
    """All files below ``path`` (optionally only names like ``*pattern*``) as one table,
    with the file name in ``file_name``."""
    reader = spark.read.format(file_format).options(**options)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", f"*{pattern}*")
    return reader.load(path).withColumn("file_name", F.col("_metadata.file_name"))


def read_cells(spark: SparkSession, path: str, file_format: str = "parquet",
               **options: str) -> DataFrame:
    """Cell tables exported from workbooks; ``options`` go to the reader (a header, say)."""
    schema = "file STRING, sheet STRING, row_idx INT, col_idx INT, value STRING"
    return spark.read.schema(schema).format(file_format).options(**options).load(path)


#: Bytes read at once from the front of a delimited file.
_FRONT = 1 << 16
#: Schemes of paths that tasks open themselves, to read no more than the head of a file.
_OPENED = ("file", "s3", "gs")


def _parquet_head(file, options: Mapping[str, str]) -> list:
    import pyarrow.parquet as parquet

    return [[field.name, str(field.type)] for field in parquet.read_schema(file)]


def _orc_head(file, options: Mapping[str, str]) -> list:
    from pyarrow import orc

    return [[field.name, str(field.type)] for field in orc.ORCFile(file).schema]


def _csv_head(file, options: Mapping[str, str]) -> list:
    """The names in the first line that is not blank, or without a header their number."""
    held = b""
    while not held.strip() or b"\n" not in held.lstrip():
        more = file.read(_FRONT)
        if not more:
            break
        held += more
    line = held.decode(options.get("encoding", "utf-8"), "replace").lstrip("\ufeff\r\n").splitlines()[:1]
    names = next(csv.reader(line, delimiter=options.get("sep", options.get("delimiter", ",")),
                            quotechar=options.get("quote", '"')), [])
    return names if options.get("header", "false").lower() == "true" else [len(names)]


_HEADS = {"parquet": _parquet_head, "orc": _orc_head, "csv": _csv_head}


def file_schemas(spark: SparkSession, path: str, pattern: str | None = None, file_format: str = "parquet",
                 **options: str) -> DataFrame:
    """``schema, n_files, files``: the files below ``path`` by what their heads say of their columns.

    Tasks read footers and first lines, so the driver sees one row a schema, whatever the number of
    files.  Tasks open local and object-store paths themselves; files of other stores reach them through
    Spark, whole.  Formats that name the columns of every row (JSON) are one schema.
    """
    listed = spark.read.format("binaryFile")
    if pattern is not None:
        listed = listed.option("pathGlobFilter", f"*{pattern}*")
    listed = listed.load(path)
    head = _HEADS.get(file_format)
    if head is None:
        told = listed.select("path", F.lit(file_format).alias("schema"))
    else:
        scheme = F.regexp_extract("path", "^([a-z0-9]+):", 1)
        opened = listed.select("path", F.lit(None).cast("binary").alias("content")).filter(scheme.isin(*_OPENED))
        carried = listed.select("path", "content").filter(~scheme.isin(*_OPENED))

        def heads(frames):
            from pyarrow import BufferReader, fs

            for frame in frames:
                schemas = []
                for name, content in zip(frame["path"], frame["content"]):
                    if content is not None:
                        schemas.append(json.dumps(head(BufferReader(content), options)))
                        continue
                    store, _, rest = name.partition(":")
                    if store == "file":
                        files, rest = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                    else:
                        files, rest = fs.FileSystem.from_uri(f"{store}:{quote(rest)}")
                    stream = files.open_input_stream if head is _csv_head else files.open_input_file
                    with stream(rest) as file:
                        schemas.append(json.dumps(head(file, options)))
                yield pd.DataFrame({"path": frame["path"], "schema": schemas})

        told = opened.unionByName(carried).mapInPandas(heads, "path string, schema string")
    return told.groupBy("schema").agg(
        F.count(F.lit(1)).alias("n_files"), F.sort_array(F.collect_list("path")).alias("files"))


def read_records(
    spark: SparkSession, path: str, pattern: str, file_format: str = "parquet",
    **options: str,
) -> DataFrame:
    """Coded records of all years as strings, tagged with ``file_year``.

    Columns may differ by year in order, number, type and spelling, in any format: one job reads the
    heads of all files, files with the same columns are one scan, names are normalised per scan, and
    the scans are joined by name.
    """
    reader = lambda: spark.read.format(file_format).options(**options)
    found = file_schemas(spark, path, pattern, file_format, **options).collect()  # one row a schema
    if not found:
        raise FileNotFoundError(f"no file named *{pattern}* below {path}")
    parts = []
    for files in sorted(row.files for row in found):
        rows = reader().schema(reader().load(files[0]).schema).load(files)
        parts.append(as_records(rows.withColumn("file_name", F.col("_metadata.file_name")), "file_name"))
    return union_by_name(*parts).drop("file_name")


def _as_text(df: DataFrame) -> list[Column]:
    """Every column as text under its normalised name; spellings of one name are coalesced."""
    spelled: dict[str, list[Column]] = {}
    for c in df.columns:
        spelled.setdefault(ascii_text(c).lower(), []).append(F.col(f"`{c}`").cast("string"))
    return [F.coalesce(*columns).alias(name) for name, columns in spelled.items()]


def as_records(df: DataFrame, file_col: str) -> DataFrame:
    """Normalise names, cast every column to text and add ``file_year`` from the file name."""
    return df.select(digits(F.col(file_col)).alias("file_year"), *_as_text(df))


def stack_records(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Coded tables by year, stacked as text; a column missing in a year becomes NULL."""
    return union_by_name(*[
        df.select(F.lit(year).alias("file_year"), *_as_text(df)) for year, df in tables.items()
    ])


def codebook(labelled: DataFrame, variables: Mapping[str, tuple[str, str]],
             keys: Sequence[str] = ("file_year",)) -> DataFrame:
    """Distinct ``(keys, variable, code, label)`` of labelled columns.

    ``variables`` maps a variable name to its (code column, label column).
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("variable"),
                F.col(code).cast("string").alias("code"),
                F.col(label).cast("string").alias("label"),
            )
            for name, (code, label) in variables.items()
        ]
    )
    rows = labelled.select(*keys, F.inline(pairs))
    return rows.filter(F.col("code").isNotNull()).distinct()


# --- tags taken from file and sheet names -------------------------------------


def digits(c: Column) -> Column:
    """Only the digits of a text."""
    return F.regexp_replace(c, "[^0-9]", "")


def without_parentheses(df: DataFrame, path_col: str) -> DataFrame:
    """Drop copies such as ``name (1).xls``; the whole path is tested."""
    return df.filter(F.col(path_col).rlike("^[^()]+$"))


def department_of(path: Column) -> Column:
    """Department from a path such as ``/dir/01 Name.xls``."""
    # Fixed value: directories, a leading number, odd characters and the suffix.
    noise = r"(^/([^/]+/)+)|([0-9]+ )|([^a-z .])|(.xls$)"
    return title_case(F.regexp_replace(F.lower(path), noise, ""))


def sheet_year(sheet: Column, base: int = 2010) -> Column:
    """A sheet named like a year, or ``base`` plus the digits of its name."""
    return F.coalesce(safe_int(sheet), F.lit(base) + digits(sheet).try_cast("int"))


# Sheet names of the aggregate workbook and the sex they hold.
SHEET_SEX = {"Hombres": "male", "Mujeres": "female", "Total": "all"}


def sheet_sex(sheet: Column) -> Column:
    return recode(sheet, SHEET_SEX)


def null_marker(value: Column, marker: str) -> Column:
    return F.nullif(value, F.lit(marker))


def skip_rows(cells: DataFrame, skip: Column | int) -> DataFrame:
    """Drop the first ``skip`` physical rows of each sheet and renumber from 1."""
    skip = F.lit(skip) if isinstance(skip, int) else skip
    return cells.filter(F.col("row_idx") > skip).withColumn(
        "row_idx", (F.col("row_idx") - skip).cast("int")
    )


def skip_override(cells: DataFrame, overrides: DataFrame, default: int,
                  keys: Sequence[str] = ("department", "sheet")) -> DataFrame:
    """Like ``skip_rows`` with a table ``(keys, skip)`` of exceptions.

    A key with two different values fails.
    """
    names = list(keys)
    once = one_per_key(overrides.select(*names, F.col("skip").alias("__skip")), names, "__skip")
    joined = natural_left_join(cells, once)
    return skip_rows(joined, F.coalesce(F.col("__skip"), F.lit(default))).drop("__skip")


def place_lookup(df: DataFrame, code: str, name: str) -> DataFrame:
    """Two-column lookup ``(muni_id, municipality)``."""
    return df.select(F.col(code).cast("string").alias("muni_id"),
                     F.col(name).alias("municipality"))
