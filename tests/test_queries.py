"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import differences, open_duckdb
from checks.oracles import ORACLES
from checks.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return open_duckdb(SF_DIR)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, connection, name):
    assert differences(spark, connection, name, SF_DIR) == []


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["triplePageUrl", "subject", "url", "predicate", "obj"]
    assert df.count() > 0
