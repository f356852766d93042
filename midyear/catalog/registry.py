"""Registry of queries and of the SQL each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = plain(sql)
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def derived(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """Run SQL whose tables are written ``{name}``; the same text runs on both engines."""
    names = set(re.findall(r"\{([a-z]+)\}", sql))
    return spark.sql(sql, **{n: table(spark, sf, n) for n in names})


def plain(sql: str) -> str:
    """The same SQL with bare table names."""
    return re.sub(r"\{([a-z]+)\}", r"\1", sql)
