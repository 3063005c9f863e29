from __future__ import annotations

import datetime as dt
import random

from samples import moment
from pyspark.sql import functions as F

from forgelens.operators import as_of, asof_join, first_by, latest_by


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_prefers_unknown_then_newest_then_ties(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "u"), ("b", 9, "v")]
    frame = spark.createDataFrame(data, "k STRING, t INT, tie STRING")
    assert sorted(map(tuple, latest_by(frame, ["k"], "t", ["tie"]).collect())) == [("a", 2, "z"), ("b", None, "u")]


def test_latest_is_limited_before_the_exchange(spark):
    """A key that holds most rows must not travel whole."""
    frame = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    kept = latest_by(frame, ["k"], "id")
    text = plan(kept)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert kept.filter("k = 0").first().id == 999


def test_first_keeps_page_order_and_one_row_without_id(spark):
    data = [(1, 1, 0, "a"), (1, 2, 0, "b"), (2, 2, 1, "c"), (None, 2, 2, "d"), (None, 3, 0, "e")]
    frame = spark.createDataFrame(data, "id BIGINT, page INT, position INT, name STRING")
    kept = first_by(frame, ["id"], ["page", "position"])
    assert sorted(r.name for r in kept.collect()) == ["a", "c", "d"]


def day(n: float) -> dt.datetime:
    return moment("2026-01-01T00:00:00") + dt.timedelta(days=n)


def random_versions(rng, keys):
    versions = []
    for key in keys:
        start = rng.uniform(0, 20)
        for number in range(rng.randint(0, 6)):
            end = start + rng.choice([0, 0.1, 0.4, 3, 11])
            versions.append((key, day(start), day(end), f"{key}-{number}"))
            start = end + rng.choice([0, 0, 2])
        if versions and versions[-1][0] == key and rng.random() < 0.5:
            k, begin, _, name = versions[-1]
            versions[-1] = (k, begin, None, name)
    return versions


def test_asof_join_equals_brute_force(spark):
    rng = random.Random(5)
    versions = random_versions(rng, range(12))
    # One key asks for a third of all rows; some rows have no key or no time.
    probes = [(0 if n % 3 == 0 else rng.randint(0, 14), n, day(rng.uniform(-2, 60))) for n in range(600)]
    probes += [(v[0], 1000 + n, v[1]) for n, v in enumerate(versions)]
    probes += [(v[0], 2000 + n, v[2]) for n, v in enumerate(versions) if v[2]]
    probes += [(None, 5000, day(1)), (1, 5001, None)]
    joined = asof_join(
        spark.createDataFrame(probes, "k BIGINT, n BIGINT, at TIMESTAMP"),
        spark.createDataFrame(versions, "k BIGINT, f TIMESTAMP, t TIMESTAMP, name STRING"),
        "k", "at", "f", "t",
    )
    expected = {}
    for key, n, at in probes:
        found = [v[3] for v in versions if at and v[0] == key and v[1] <= at and (v[2] is None or at < v[2])]
        assert len(found) <= 1
        expected[n] = found[0] if found else None
    result = joined.collect()
    assert len(result) == len(probes)
    assert {r.n: r.name for r in result} == expected
    assert sum(v is not None for v in expected.values()) > 100


def test_as_of_takes_versions_valid_at_a_moment(spark):
    history = spark.createDataFrame(
        [(1, day(0), day(2)), (1, day(2), None), (2, day(5), None)],
        "k BIGINT, dbt_valid_from TIMESTAMP, dbt_valid_to TIMESTAMP",
    )
    at_two = as_of(history, F.lit(day(2))).collect()
    assert [(r.k, r.dbt_valid_to) for r in at_two] == [(1, None)]
    assert as_of(history, F.lit(day(6))).count() == 2
