"""Every query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import check_oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    assert check_oracle.differences(spark, con, SF_DIR, name)[0] == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["id_a", "id_b", "similarity"]
