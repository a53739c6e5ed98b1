import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from brindle.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_parts(spark):
    """Keep every shuffle partition, so that small data still spreads over several tasks."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, before)


@pytest.fixture
def rows():
    def collect(df, *cols):
        cols = cols or df.columns
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    return collect
