"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast joins from measured sizes, splits skewed join
# partitions and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Do not record the Python call site of every column: plans are built much faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "midyear", **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword names use ``__`` for the dots."""
    builder = SparkSession.builder.appName(name)
    merged = SETTINGS | {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
