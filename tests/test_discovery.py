"""Schemas of many files, found by tasks."""

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from midyear.sources.scans import file_schemas, read_records


def _jobs(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


KINDS = ["codigo,ano\n{i},a\n", "ano,codigo\na,{i}\n", "﻿Código,SEXO\n{i},m\n"]


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    jobs = []
    for n in (150, 2000):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            letters = str(i).translate(str.maketrans("0123456789", "abcdefghij"))
            (folder / f"births_{1900 + i % 100}_{letters}.csv").write_text(KINDS[i % 3].format(i=i), "utf-8")
        found, heads = _jobs(
            spark, lambda: file_schemas(spark, str(folder), "births", "csv", header="true").collect())
        assert len(found) == 3 and sum(r.n_files for r in found) == n
        read, reads = _jobs(spark, lambda: read_records(spark, str(folder), "births", "csv", header="true"))
        jobs.append((heads, reads))
        assert set(read.columns) == {"file_year", "codigo", "ano", "sexo"}
    assert jobs[0] == jobs[1] and jobs[0][0] <= 3
    assert read.count() == 2000 and read.filter("ano = 'a'").count() == 1334


def test_heads_of_parquet_and_csv(spark, tmp_path):
    for i, table in enumerate([{"a": [1], "b": ["x"]}, {"a": ["1"], "b": ["x"]}, {"a": [2], "b": ["y"]}]):
        pq.write_table(pa.table(table), tmp_path / f"births_{i}.parquet")
    found = file_schemas(spark, str(tmp_path), "births").collect()
    assert sorted((r.schema, r.n_files) for r in found) == [
        ('[["a", "int64"], ["b", "string"]]', 2), ('[["a", "string"], ["b", "string"]]', 1)]
    assert sorted(tuple(r) for r in read_records(spark, str(tmp_path), "births").collect()) == [
        ("0", "1", "x"), ("1", "1", "x"), ("2", "2", "y")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "plain_1.csv").write_text('"a;b";c\n')
    (tmp_path / "c" / "plain_2.csv").write_text("")
    found = file_schemas(spark, str(tmp_path / "c"), "plain", "csv", sep=";").collect()
    assert [(r.schema, r.n_files) for r in found] == [("[2]", 1)]  # an empty file has neither head nor rows
    with pytest.raises(FileNotFoundError):
        read_records(spark, str(tmp_path), "nothing")
