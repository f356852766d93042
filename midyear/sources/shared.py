"""The shared folder of the cluster, and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RUN: ContextVar[str | None] = ContextVar("midyear_run_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session in one process (``local``, not ``local-cluster``) without that setting gets a
    temporary folder, which goes with the process; on a cluster a machine-local folder would be
    lost with its machine, so this raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="midyear-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in the present run's folder there, that nothing else uses."""
    folder = _RUN.get() or shared_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for what a job writes on its way; it is removed when the job ends."""
    path = fresh_path(spark, "run")
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there (runs a job)."""
    path = fresh_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
