import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from midyear.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", spark__master="local[4]", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture
def values(spark):
    """Evaluate expressions over a one-row table per input."""

    def run(data, schema, *expressions):
        out = spark.createDataFrame(data, schema).coalesce(1).select(*expressions).collect()
        return [tuple(r) if len(r) > 1 else r[0] for r in out]

    return run
