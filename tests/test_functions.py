from __future__ import annotations

import hashlib
import re

from samples import moment
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgelens import functions as fn


def value(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_hours_count_boundaries_not_elapsed_time(spark):
    def hours(a, b):
        return value(spark, fn.hour_boundaries(F.lit(moment(a)), F.lit(moment(b))))

    assert hours("2026-04-25T07:59:00", "2026-04-25T08:01:00") == 1
    assert hours("2026-04-25T08:01:00", "2026-04-25T08:59:59") == 0
    assert hours("2026-04-25T23:59:00", "2026-04-26T01:00:00") == 2
    assert hours("2026-04-25T08:01:00", "2026-04-25T07:59:00") == -1
    assert hours("1960-01-01T00:30:00", "1960-01-01T01:10:00") == 1


def test_unknown_end_gives_no_hours(spark):
    assert value(spark, fn.hour_boundaries(F.lit(moment("2026-01-01T00:00:00")), F.lit(None).cast("timestamp"))) is None


def test_days_count_midnights(spark):
    days = fn.day_boundaries(F.lit(moment("2026-04-25T23:59:00")), F.lit(moment("2026-04-26T00:01:00")))
    assert value(spark, days) == 1


def test_star_tiers(spark):
    stars = [None, 0, 9, 10, 99, 100, 999, 1000, 5000]
    frame = spark.createDataFrame([(s,) for s in stars], "s BIGINT").select(fn.star_tier(F.col("s")))
    expected = ["minimal"] * 3 + ["low"] * 2 + ["medium"] * 2 + ["high"] * 2
    assert [r[0] for r in frame.collect()] == expected


def test_percent_rounds_half_up_and_needs_a_whole(spark):
    assert value(spark, fn.percent(F.lit(1), F.lit(16))) == 6.3
    assert value(spark, fn.percent(F.lit(0), F.lit(0))) is None


def test_surrogate_key_is_md5_of_joined_text(spark):
    frame = spark.createDataFrame([(7, "run"), (None, "run")], "a BIGINT, b STRING")
    keys = [r[0] for r in frame.select(fn.surrogate_key("a", "b")).collect()]
    assert keys == [
        hashlib.md5(text.encode()).hexdigest() for text in ("7-run", "_dbt_utils_surrogate_key_null_-run")
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab/.:-", max_size=12), min_size=30, max_size=60))
def test_repo_slug_equals_the_pattern(spark, urls):
    frame = spark.createDataFrame([(u,) for u in urls], "u STRING").select("u", fn.repo_slug(F.col("u")).alias("slug"))
    for url, slug in frame.collect():
        match = re.search(r"[^/]+/[^/]+$", url)
        assert slug == (match.group(0) if match else None), url


def test_repo_slug_samples(spark):
    urls = ["https://api.example.org/repos/a/b", "a/b", "nothing", "a/b/", "a//b", "/b", "", None]
    frame = spark.createDataFrame([(u,) for u in urls], "u STRING").select(fn.repo_slug(F.col("u")))
    assert [r[0] for r in frame.collect()] == ["a/b", "a/b", None, None, None, None, None, None]
