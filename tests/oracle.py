"""Comparison of a Spark result with its SQL on the same parquet files."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(_plain(v) for v in value.values())
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0)
                                           for v in r))


def _kind(name: str) -> str:
    name = name.lower()
    if name in ("string", "varchar"):
        return "text"
    if name in ("bigint", "int", "integer", "smallint", "tinyint", "hugeint"):
        return "whole"
    if name in ("double", "float"):
        return "double"
    return name.split("(")[0].removesuffix("_ntz")


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """Row count and a list of differences (empty when equal)."""
    spark_rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    rows = result.fetchall()
    problems = []
    if sorted(columns) != sorted(df.columns):
        return len(spark_rows), [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for name, kind in df.dtypes:
        if _kind(kind) != kinds[name] and not kind.startswith(("array", "struct")):
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(rows) != len(spark_rows):
        problems.append(f"rows {len(spark_rows)} != {len(rows)}")
    a, b = _sorted(df.columns, spark_rows), _sorted(columns, rows)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {str(bad)[:900]}")
    return len(spark_rows), problems


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from midyear.session import build_session

    shared, sf_dir, *chosen = sys.argv[1:]
    spark = build_session("oracle", spark__master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__showConsoleProgress="false", spark__checkpoint__dir=shared,
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            if name in sqls:
                n, problems = compare(fn(spark, sf_dir), con, sqls[name])
            else:
                n, problems = fn(spark, sf_dir).count(), []
                name += " (rows only)"
        except Exception as error:  # noqa: BLE001 - report every query
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name:24} {n:8} rows {time.time() - start:6.2f}s",
              *problems, sep="\n     " if problems else " ", flush=True)
    print("bad:", bad)
