"""Corpus queries next to their SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import oracle
import pytest

from forgelens.llm import oracles, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(spark, oracle.duck(SF_DIR), queries.queries()[name], oracles.oracle_sql()[name], SF_DIR) == []
