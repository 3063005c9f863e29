"""Facts kept by landed day against facts of the whole."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from samples import UTC, envelope_lines, rows, sample_payloads

from forgelens.operators.quality import QualityError
from forgelens.plans import jobs
from forgelens.plans.build import build
from forgelens.plans.facts import fact_issues
from forgelens.plans.staging import stage
from forgelens.plans.stores import DailyFacts
from forgelens.schemas import RESOURCES
from forgelens.sources import landing
from forgelens.sources.sliced import SlicedTable

LOADED = "2026-05-20 00:00:00"


def day(n):
    return dt.date(2026, 5, 16 + n)


def land(spark, base, n, ids, run, title="t", created=1):
    frame = spark.createDataFrame([(i, f"{title}{i}", "open", dt.datetime(2026, 5, created, tzinfo=UTC)) for i in ids],
                                  "id BIGINT, title STRING, state STRING, created_at TIMESTAMP")
    at = dt.datetime(2026, 5, 16 + n, 6, tzinfo=UTC)
    landing.replace_day(landing.envelopes(frame, "issues", run, at), f"{base}/in", "issues", day(n))
    jobs.load_days(spark, f"{base}/in", f"{base}/raw", day(n), day(n), F.lit(LOADED), ["issues"])


@pytest.fixture
def tables(spark, tmp_path):
    base = str(tmp_path)
    return base, SlicedTable(spark, f"{base}/raw/issues"), DailyFacts(spark, f"{base}/facts", "issues")


def advance(raw, made):
    written = made.write(raw)
    made.commit(written)
    return written


def whole(raw):
    return rows(fact_issues(stage(raw.read(), "issues")), "issue_snapshot_id", "issue_id", "run_id", "title")


def stored(made):
    return rows(made.read(), "issue_snapshot_id", "issue_id", "run_id", "title")


def test_only_new_days_are_written(spark, tables):
    base, raw, made = tables
    land(spark, base, 1, [1, 2], "r1")
    land(spark, base, 2, [2, 3], "r2")
    assert {d for _, d in advance(raw, made).seen} == {day(1), day(2)}
    land(spark, base, 3, [4], "r3")
    assert {d for _, d in advance(raw, made).seen} == {day(3)}
    assert stored(made) == whole(raw)
    assert advance(raw, made) is None
    land(spark, base, 2, [9], "r4", title="again")
    assert {d for _, d in advance(raw, made).seen} == {day(2)}
    assert stored(made) == whole(raw)


def test_an_emptied_day_leaves_the_facts(spark, tables):
    base, raw, made = tables
    land(spark, base, 1, [1], "r1")
    land(spark, base, 2, [2], "r2")
    advance(raw, made)
    land(spark, base, 1, [], "r1")
    advance(raw, made)
    assert stored(made) == whole(raw) and made.read().count() == 1
    assert advance(raw, made) is None


def test_days_of_one_run_are_built_together(spark, tables):
    base, raw, made = tables
    land(spark, base, 1, [1, 2], "shared", title="early")
    land(spark, base, 3, [5], "other")
    advance(raw, made)
    # The later day of the run holds a later row of issue 2, which takes it from the first day.
    land(spark, base, 2, [2], "shared", title="late", created=2)
    assert made.pending(raw.state()) == [day(1), day(2)]
    advance(raw, made)
    assert stored(made) == whole(raw)
    assert ("late2",) in rows(made.read(), "title") and ("early2",) not in rows(made.read(), "title")
    # Without it the first day has the issue again.
    land(spark, base, 2, [], "shared")
    advance(raw, made)
    assert stored(made) == whole(raw) and ("early2",) in rows(made.read(), "title")


def test_a_day_prunes_the_folders_of_others(spark, tables):
    base, raw, made = tables
    for n in (1, 2, 3):
        land(spark, base, n, [n], f"r{n}")
    advance(raw, made)
    one = made.read().filter(F.col(DailyFacts.DAY) == F.lit(day(2)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert DailyFacts.DAY in plan.split("PartitionFilters:")[1].split("]")[0]
    assert rows(one, "issue_id") == [(2,)]
    assert len(made.read([day(3)]).inputFiles()) == 1


def test_a_build_stores_facts_by_day_and_checks_the_new_days(spark, tmp_path):
    base = str(tmp_path)
    payloads = sample_payloads()

    def load(n, run, changed=None):
        for resource in RESOURCES:
            records = [changed(dict(r)) if changed else r for r in payloads[resource]]
            lines = envelope_lines(resource, records, run, f"2026-05-{16 + n}T06:00:00+00:00")
            folder = f"{base}/in/{resource}/year=2026/month=05/day={16 + n}"
            spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.mode("overwrite").text(folder)
        jobs.load_days(spark, f"{base}/in", f"{base}/raw", day(n), day(n), F.lit(LOADED))
        return {r: SlicedTable(spark, f"{base}/raw/{r}") for r in RESOURCES}

    def run(n, tag, changed=None):
        landed = load(n, f"run-{n}", changed)
        return build(spark, jobs.raw_tables(spark, f"{base}/raw"), f"{base}/warehouse", tag, landed=landed)

    run(1, "1")
    out = run(2, "2")
    assert out.tables["fact_issues"].count() == 6
    checked = {r.n_checked for r in out.outcomes if r.table_name == "fact_issues" and r.rule == "not_null"}
    assert checked == {3}
    with pytest.raises(QualityError, match="stg_"):
        run(3, "3", lambda r: r | {"state": "lost"})
    assert DailyFacts(spark, f"{base}/warehouse/fact_issues", "issues").read().count() == 6
