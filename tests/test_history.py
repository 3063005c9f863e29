from __future__ import annotations

import datetime as dt
import random

import pytest
from samples import moment
from pyspark.sql import functions as F

from forgelens.operators import scd2
from forgelens.plans.stores import RepoHistory
from forgelens.schemas import WATCHED

WATCH = ("stars", "topics")
SCHEMA = (
    "repo_id BIGINT, run_id STRING, extracted_at TIMESTAMP, updated_at TIMESTAMP, stars BIGINT, "
    "topics ARRAY<STRING>, size BIGINT, airbyte_extracted_at TIMESTAMP, airbyte_raw_id STRING"
)
TIES = ("airbyte_extracted_at", "airbyte_raw_id")


def day(n: float) -> dt.datetime:
    return moment("2026-01-01T00:00:00") + dt.timedelta(days=n)


def listing(run: int, entries: dict[int, tuple]) -> list[tuple]:
    """``entries``: key -> (stars, topics, updated day)."""
    return [
        (key, f"run-{run}", day(run), None if updated is None else day(updated), stars, topics, run, day(run), f"{run}-{key}")
        for key, (stars, topics, updated) in entries.items()
    ]


def by_runs(spark, runs: list[list[tuple]], hard_deletes: str = "close"):
    """The history built run by run."""
    open_versions, closed = None, []
    for number, rows in enumerate(runs, start=1):
        incoming = spark.createDataFrame(rows, SCHEMA)
        out = scd2.advance(open_versions, incoming, "repo_id", WATCH, F.lit(day(number)), hard_deletes)
        taken = out.collect()
        closed += [r for r in taken if r.state == "closed"]
        still = [r[:-1] for r in taken if r.state == "open"]
        open_versions = spark.createDataFrame(still, out.drop("state").schema)
    return facts(closed) | facts(open_versions.collect())


def facts(rows) -> set:
    return {
        (r.repo_id, r.run_id, r.stars, r.dbt_scd_id, r.dbt_updated_at, r.dbt_valid_from, r.dbt_valid_to) for r in rows
    }


def replayed(spark, runs, hard_deletes: str = "close"):
    staged = spark.createDataFrame([row for rows in runs for row in rows], SCHEMA)
    complete = scd2.number_runs(staged, "extracted_at") if hard_deletes == "close" else None
    return scd2.replay(staged, "repo_id", WATCH, TIES, complete).collect()


def test_each_case(spark):
    runs = [
        listing(1, {1: (5, ["a"], 0.5), 2: (5, ["a"], 0.5), 3: (5, None, 0.5), 4: (5, ["a"], 0.5)}),
        listing(2, {1: (5, ["a"], 1.5), 2: (6, ["a"], 1.5), 3: (5, ["b"], 1.5), 5: (1, [], None)}),
        listing(3, {1: (5, ["a"], 2.5), 2: (6, ["a"], 2.5), 4: (5, ["a"], 2.5), 5: (1, [], None)}),
    ]
    versions = {(r.repo_id, r.run_id): (r.dbt_valid_from, r.dbt_valid_to) for r in replayed(spark, runs)}
    naive = {k: tuple(v and v.replace(tzinfo=dt.timezone.utc) for v in pair) for k, pair in versions.items()}
    assert naive == {
        (1, "run-1"): (day(0.5), None),  # unchanged: keeps its first row, although its change time moved
        (2, "run-1"): (day(0.5), day(1.5)),  # changed: closed at the new row's change time
        (2, "run-2"): (day(1.5), None),
        (3, "run-1"): (day(0.5), day(1.5)),  # unknown topics became known
        (3, "run-2"): (day(1.5), day(3)),  # vanished: closed at the run
        (4, "run-1"): (day(0.5), day(2)),
        (4, "run-3"): (day(2.5), None),  # returned with the same values: a new version
        (5, "run-2"): (day(2), None),  # no change time: the extraction time counts
    }
    assert facts(replayed(spark, runs)) == by_runs(spark, runs)


@pytest.mark.parametrize("hard_deletes", ["close", "ignore"])
def test_replay_equals_run_by_run_on_random_runs(spark, hard_deletes):
    rng = random.Random(11)
    runs = []
    for run in range(1, 7):
        keys = [k for k in range(30) if rng.random() < 0.8]
        runs.append(
            listing(
                run,
                {k: (rng.choice([1, 2, None]), rng.choice([["a"], ["b"], None]), run - rng.choice([0.2, 0.5])) for k in keys},
            )
        )
    result = replayed(spark, runs, hard_deletes)
    assert facts(result) == by_runs(spark, runs, hard_deletes)
    assert len({r.dbt_scd_id for r in result}) == len(result)
    open_keys = [r.repo_id for r in result if r.dbt_valid_to is None]
    assert len(open_keys) == len(set(open_keys))


def test_several_rows_per_run_count_once(spark):
    rows = listing(1, {1: (5, ["a"], 0.5)}) + [
        (1, "run-1", day(1.5), day(0.9), 7, ["a"], 1, day(1.5), "later"),
    ]
    (version,) = replayed(spark, [rows])
    assert version.stars == 7


def test_unmoved_change_time_still_gives_distinct_ids(spark):
    runs = [listing(1, {1: (5, ["a"], 0.5)}), listing(2, {1: (6, ["a"], 0.5)})]
    result = replayed(spark, runs)
    assert len({r.dbt_scd_id for r in result}) == 2
    assert sum(r.dbt_valid_from == r.dbt_valid_to for r in result) == 1


def test_unknown_delete_policy_is_refused(spark):
    with pytest.raises(ValueError):
        scd2.advance(None, spark.createDataFrame([], SCHEMA), "repo_id", WATCH, F.lit(None), "maybe")


def test_runs_that_list_different_keys_close_nothing(spark, tmp_path):
    days = [listing(1, {k: (k, ["a"], 0.5) for k in (1, 2, 3)}), listing(2, {k: (k, ["a"], 1.5) for k in (4, 5, 6)})]
    rows = replayed(spark, days, "ignore")
    assert sorted(r.repo_id for r in rows if r.dbt_valid_to is None) == [1, 2, 3, 4, 5, 6]


def test_rows_without_a_run_take_part(spark):
    rows = listing(1, {1: (5, ["a"], 0.5), 2: (5, ["a"], 0.5)})
    rows = [rows[0], (2, None, *rows[1][2:])]
    assert sorted(r.repo_id for r in replayed(spark, [rows], "ignore")) == [1, 2]


def test_no_job_runs_while_the_history_is_planned(spark):
    staged = spark.createDataFrame(listing(1, {1: (5, ["a"], 0.5)}), SCHEMA)
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        scd2.replay(staged, "repo_id", WATCH, TIES)
        scd2.replay(staged, "repo_id", WATCH, TIES, scd2.number_runs(staged, "extracted_at"))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# ------------------------------------------------------------------ stored history


def staged_run(spark, run: int, stars: dict[int, int]):
    frame = spark.createDataFrame(
        [(k, s, f"run-{run}", day(run), day(run - 0.5), f"{run}-{k}") for k, s in stars.items()],
        "repo_id BIGINT, stargazers_count BIGINT, run_id STRING, extracted_at TIMESTAMP, updated_at TIMESTAMP, airbyte_raw_id STRING",
    ).withColumn("airbyte_extracted_at", F.col("extracted_at"))
    for name in WATCHED:
        if name not in frame.columns:
            kind = "array<string>" if name == "topics" else "string"
            frame = frame.withColumn(name, F.lit(None).cast(kind))
    return frame


def spans(history) -> list[tuple]:
    return sorted((r.repo_id, r.stargazers_count, r.dbt_valid_to is None) for r in history.read().collect())


def test_stored_history_repeats_and_refuses(spark, tmp_path):
    history = RepoHistory(spark, str(tmp_path / "h"))
    with pytest.raises(FileNotFoundError):
        history.read()
    history.apply(staged_run(spark, 1, {1: 5, 2: 5}), "20260102", F.lit(day(1)))
    history.apply(staged_run(spark, 2, {1: 6, 3: 1}), "20260103", F.lit(day(2)))
    expected = [(1, 5, False), (1, 6, True), (2, 5, False), (3, 1, True)]
    assert spans(history) == expected
    # The same run again changes nothing, a corrected one replaces it.
    history.apply(staged_run(spark, 2, {1: 6, 3: 1}), "20260103", F.lit(day(2)))
    assert spans(history) == expected
    history.apply(staged_run(spark, 2, {1: 5, 2: 5}), "20260103", F.lit(day(2)))
    assert spans(history) == [(1, 5, True), (2, 5, True)]
    with pytest.raises(ValueError):
        history.apply(staged_run(spark, 1, {1: 5}), "20260102", F.lit(day(1)))


def test_tags_with_leading_zeros_are_text(spark, tmp_path):
    history = RepoHistory(spark, str(tmp_path / "h"))
    history.apply(staged_run(spark, 1, {1: 5}), "001", F.lit(day(1)))
    history.apply(staged_run(spark, 2, {1: 6}), "002", F.lit(day(2)))
    assert spans(history) == [(1, 5, False), (1, 6, True)]


def test_a_written_run_is_not_seen_before_its_commit(spark, tmp_path):
    history = RepoHistory(spark, str(tmp_path / "h"))
    history.apply(staged_run(spark, 1, {1: 5}), "001", F.lit(day(1)))
    assert history.write(staged_run(spark, 2, {1: 6}), "002", F.lit(day(2))).count() == 2
    assert spans(history) == [(1, 5, True)]


def test_unfinished_run_is_not_seen(spark, tmp_path, monkeypatch):
    history = RepoHistory(spark, str(tmp_path / "h"))
    history.apply(staged_run(spark, 1, {1: 5}), "20260102", F.lit(day(1)))
    monkeypatch.setattr(history._log, "add", lambda tag: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        history.apply(staged_run(spark, 2, {1: 9}), "20260103", F.lit(day(2)))
    assert spans(RepoHistory(spark, str(tmp_path / "h"))) == [(1, 5, True)]


def test_a_row_of_a_run_that_is_not_complete_fails_instead_of_being_lost(spark):
    rows = listing(1, {1: (5, ["a"], 1)}) + listing(2, {2: (5, ["a"], 2)})
    staged = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame([("run-1", day(1))], "run_id STRING, finished_at_utc TIMESTAMP")
    history = scd2.replay(staged, "repo_id", WATCH, TIES, scd2.number_runs(known))
    with pytest.raises(Exception, match="run-2"):
        history.collect()
    both = spark.createDataFrame([("run-1", day(1)), ("run-2", day(2))], "run_id STRING, finished_at_utc TIMESTAMP")
    assert scd2.replay(staged, "repo_id", WATCH, TIES, scd2.number_runs(both)).count() == 2
