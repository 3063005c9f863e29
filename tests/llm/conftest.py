from __future__ import annotations

import pytest
from corpora import CLASHING, documents, odd_rows

from forgelens.llm import common


@pytest.fixture(autouse=True)
def workers_see_the_package(spark):
    common.ready(spark)


@pytest.fixture
def odd(spark):
    from pyspark.sql import functions as F

    plain = documents(spark, odd_rows())
    return plain.withColumns({name: F.lit(f"other {name}") for name in CLASHING})


@pytest.fixture
def empty(spark):
    return documents(spark, [])
