"""Snapshot and report sinks."""

from __future__ import annotations

import csv
import io
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from midyear.sources.shared import fresh_path


def write_snapshot(df: DataFrame, path: str, partition_by: str = "year") -> None:
    """Parquet, one folder per ``partition_by`` value, so that later reads prune years.

    The rebalance hint keeps the number of files per folder low and lets adaptive
    execution split a year that holds most of the rows over several tasks.
    """
    df.hint("rebalance", partition_by).write.mode("errorifexists").partitionBy(
        partition_by).parquet(path)


def _paths(spark: SparkSession, path: str):
    """The file system of a path, and a function from text to its paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _manifests(spark: SparkSession, path: str) -> list[int]:
    files, hadoop = _paths(spark, path)
    found = files.globStatus(hadoop(f"{path}/_manifests/[0-9]*")) or []
    return sorted(int(f.getPath().getName()) for f in found)


def manifest(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of each partition value of the present snapshot; none where nothing was switched yet."""
    numbers = _manifests(spark, path)
    if not numbers:
        return {}
    files, hadoop = _paths(spark, path)
    stream = files.open(hadoop(f"{path}/_manifests/{numbers[-1]:012d}"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def switch(spark: SparkSession, path: str, folders: dict[str, str], before: int) -> None:
    """Put the next manifest in place by one rename; fails if another run has switched since ``before``."""
    files, hadoop = _paths(spark, path)
    made = hadoop(f"{path}/_manifests/_{uuid.uuid4().hex}")
    stream = files.create(made)
    stream.write(json.dumps(folders, sort_keys=True).encode())
    stream.close()
    final = hadoop(f"{path}/_manifests/{before + 1:012d}")
    if files.exists(final) or not files.rename(made, final):
        files.delete(made, False)
        raise RuntimeError(f"another run has switched the snapshot {path}")


def write_years(df: DataFrame, path: str, partition_by: str = "year") -> None:
    """Put the years of ``df`` into a snapshot with a manifest: those replace the old ones, the rest stays.

    New years are written beside the old ones, and one manifest switches to them.  A run that breaks off
    before leaves the old snapshot as it was; readers see all of the old one or all of the new one.
    Folders that no manifest names any longer stay until ``sweep``.
    """
    spark = df.sparkSession
    numbers, folders = _manifests(spark, path), manifest(spark, path)
    run = f"run-{uuid.uuid4().hex}"
    write_snapshot(df, f"{path}/{run}", partition_by)
    files, hadoop = _paths(spark, path)
    for year in files.globStatus(hadoop(f"{path}/{run}/{partition_by}=*")) or []:
        name = year.getPath().getName()
        folders[name] = f"{run}/{name}"
    switch(spark, path, folders, numbers[-1] if numbers else 0)


def sweep(spark: SparkSession, path: str, partition_by: str = "year") -> int:
    """Delete the year folders and manifests that the present manifest does not need; how many folders."""
    files, hadoop = _paths(spark, path)
    numbers, used, gone = _manifests(spark, path), set(manifest(spark, path).values()), 0
    for year in files.globStatus(hadoop(f"{path}/run-*/{partition_by}=*")) or []:
        where = year.getPath()
        if f"{where.getParent().getName()}/{where.getName()}" not in used:
            files.delete(where, True)
            gone += 1
    for number in numbers[:-1]:
        files.delete(hadoop(f"{path}/_manifests/{number:012d}"), False)
    return gone


def read_snapshot(spark: SparkSession, path: str, schema=None, partition_by: str = "year") -> DataFrame:
    """A snapshot, with or without a manifest; give the schema to keep partition column types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    folders = manifest(spark, path)
    if not folders:
        return reader.parquet(path)
    by_run: dict[str, list[str]] = {}
    for folder in folders.values():
        by_run.setdefault(folder.split("/")[0], []).append(f"{path}/{folder}")
    parts = [reader.option("basePath", f"{path}/{run}").parquet(*years) for run, years in sorted(by_run.items())]
    return reduce(DataFrame.unionByName, parts)


def write_ordered_csv(df: DataFrame, path: str, null_value: str = "NA") -> None:
    """One CSV file with one header, its lines in the order of ``df`` (an ``orderBy``).

    The rows are sorted over all tasks and written as parts in order; the bytes of the parts are then
    strung together through one buffer.  No task gets all rows.
    """
    spark = df.sparkSession
    parts = fresh_path(spark, "ordered-parts")
    df.write.option("header", False).option("nullValue", null_value).csv(parts)
    files, hadoop = _paths(spark, parts)
    target, at = _paths(spark, path)
    where = at(path)
    if target.exists(where):
        raise FileExistsError(path)
    made = at(f"{path}.{uuid.uuid4().hex}")
    stream = target.create(made)
    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(df.columns)
    stream.write(line.getvalue().encode())
    listed = sorted(str(f.getPath()) for f in files.globStatus(hadoop(f"{parts}/part-*")) or [])
    for part in listed:  # part numbers are in the order of the sort
        source = files.open(hadoop(part))
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, 1 << 22, False)
        source.close()
    stream.close()
    if not target.rename(made, where):
        raise RuntimeError(f"cannot put {path} in place")
    files.delete(hadoop(parts), True)


def write_csv(df: DataFrame, path: str, null_value: str = "NA") -> None:
    df.write.mode("errorifexists").option("header", True).option(
        "nullValue", null_value).csv(path)


def read_csv(spark: SparkSession, path: str, schema, null_value: str = "NA") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option(
        "nullValue", null_value).csv(path)
