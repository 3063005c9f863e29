"""Every registered query next to its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as driver
from forgelens import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_its_sql(spark, duck, name):
    assert oracle.compare(spark, duck, driver.queries()[name], driver.oracle_sql()[name], SF_DIR) == []


def test_entry(spark):
    frame = driver.entry(spark)
    # Every repository that any run has listed, since no run lists all of them.
    assert frame.count() == 200 and "health_score" in frame.columns
