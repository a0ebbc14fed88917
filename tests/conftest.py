import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagelore.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Make a table of text columns from rows: ``table("a b", [("x", "y"), ...])``."""

    def make(names, rows):
        schema = ", ".join(f"{name} string" for name in names.split())
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def with_conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ordered(tuples):
    """Sorted, nulls first."""
    return sorted(tuples, key=lambda row: [(value is not None, str(value)) for value in row])


def rows(df):
    """All rows as sorted plain tuples."""
    return ordered(tuple(row) for row in df.collect())
