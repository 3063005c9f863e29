"""Goldens worked out by hand from the nine sample records."""

from __future__ import annotations

import datetime as dt

import pytest
from samples import rows
from pyspark.sql import functions as F

from forgelens.plans import dims, facts, marts, reports, snapshot


@pytest.fixture(scope="module")
def history(staged):
    return snapshot.repos_snapshot(staged["repositories"])


def test_trending(history):
    mart = marts.mart_trending_repos(history)
    week = F.date_format("created_week", "yyyy-MM-dd").alias("week")
    assert rows(mart, "repo_id", "star_tier", week, "days_since_creation") == [
        (100001, "medium", "2026-04-20", 0), (100002, "medium", "2026-04-20", 0), (100003, "low", "2026-04-20", 0)
    ]
    by_tier = [(r.star_tier, r.repos, r.avg_stars) for r in reports.trending_by_tier(mart).collect()]
    assert by_tier == [("medium", 2, 237.5), ("low", 1, 56.0)]


def test_archived_disabled_and_unknown_flags_are_not_trending(history):
    changed = history.withColumn(
        "is_archived", F.when(F.col("repo_id") == 100001, True).when(F.col("repo_id") == 100003, False)
    )
    assert rows(marts.mart_trending_repos(changed), "repo_id") == [(100003,)]


def test_developer_activity(history):
    mart = marts.mart_developer_activity(history)
    assert rows(
        mart, "owner_login", "repos_created", "original_repos", "forked_repos", "total_stars", "distinct_languages",
        "primary_language", "active_days_span",
    ) == [
        ("alice", 1, 1, 0, 128, 1, "Python", 0),
        ("bob", 1, 1, 0, 347, 1, "Python", 0),
        ("carol", 1, 1, 0, 56, 1, "Python", 0),
    ]
    assert {tuple(r.languages_used) for r in mart.collect()} == {("Python",)}


def test_developer_languages_ties_and_unknowns(history):
    base = history.limit(1)
    wanted = [("b", 4, True), ("a", None, False), ("a", 2, None), ("b", 3, None), (None, 1, False), (None, 1, False), (None, 1, True)]
    many = None
    for number, (language, stars, is_fork) in enumerate(wanted):
        row = (
            base.withColumn("repo_id", F.lit(number).cast("bigint"))
            .withColumn("language", F.lit(language).cast("string"))
            .withColumn("stargazers_count", F.lit(stars).cast("bigint"))
            .withColumn("is_fork", F.lit(is_fork).cast("boolean"))
            .withColumn("owner_login", F.lit("one"))
            .withColumn("owner_id", F.lit(None).cast("bigint"))
        )
        many = row if many is None else many.unionByName(row)
    out = marts.mart_developer_activity(many).first()
    assert out.languages_used == ["a", "b"] and out.primary_language == "a" and out.distinct_languages == 2
    # A repository that may or may not be a fork counts as neither.
    assert (out.repos_created, out.original_repos, out.forked_repos) == (7, 3, 2)
    assert out.total_stars == 12 and out.avg_stars_per_repo == 2.0
    only_unknown = marts.mart_developer_activity(many.filter("language IS NULL")).first()
    assert only_unknown.languages_used == [] and only_unknown.primary_language is None


def test_community_health(history, staged):
    mart = marts.mart_community_health(history, staged["issues"], staged["pull_requests"])
    assert rows(
        mart, "repo_id", "tracked_issues", "tracked_open_issues", "tracked_closed_issues", "tracked_prs", "merged_prs",
        "open_prs", "issue_close_rate_pct", "pr_merge_rate_pct", "avg_issue_comments", "avg_pr_comments", "health_score",
    ) == [
        (100001, 1, 1, 0, 1, 0, 1, 0.0, 0.0, 2.0, 3.0, 90),
        (100002, 1, 0, 1, 1, 1, 0, 100.0, 100.0, 4.0, 5.0, 100),
        (100003, 1, 1, 0, 1, 0, 1, 0.0, 0.0, 0.0, 1.0, 80),
    ]


def test_health_joins_any_letter_case_without_fan_out(history, staged):
    shouting = staged["issues"].withColumn("repo_full_name", F.upper("repo_full_name"))
    both = staged["issues"].unionByName(shouting)
    mart = marts.mart_community_health(history, both, staged["pull_requests"])
    assert rows(mart, "repo_id", "tracked_issues") == [(100001, 2), (100002, 2), (100003, 2)]
    once = marts.mart_community_health(history, both, staged["pull_requests"], dedup=True)
    assert rows(once, "repo_id", "tracked_issues") == [(100001, 1), (100002, 1), (100003, 1)]


def test_health_without_any_records(history, staged):
    mart = marts.mart_community_health(
        history, staged["issues"].filter("false"), staged["pull_requests"].filter("false")
    )
    assert rows(mart, "repo_id", "tracked_issues", "issue_close_rate_pct", "avg_pr_comments", "health_score") == [
        (100001, 0, None, 0.0, 50), (100002, 0, None, 0.0, 60), (100003, 0, None, 0.0, 40)
    ]


def test_facts(staged):
    issues = facts.fact_issues(staged["issues"])
    assert rows(issues, "issue_id", F.coalesce("hours_to_close", F.lit(-1))) == [(300001, -1), (300002, 3), (300003, -1)]
    prs = facts.fact_pull_requests(staged["pull_requests"])
    assert rows(prs, "pr_id", F.coalesce("hours_to_close", F.lit(-1)), "is_merged") == [
        (200001, -1, False), (200002, 3, True), (200003, -1, False)
    ]
    assert {r.date_key for r in prs.collect()} == {dt.date(2026, 4, 25)}
    snapshots = facts.fact_repo_snapshots(staged["repositories"])
    assert rows(snapshots, "repo_id", "snapshot_date") == [(k, dt.date(2026, 4, 25)) for k in (100001, 100002, 100003)]
    assert (len(issues.columns), len(prs.columns), len(snapshots.columns)) == (20, 23, 16)


def test_developers(staged):
    people = dims.dim_developers(staged["repositories"], staged["pull_requests"], staged["issues"])
    assert people.count() == 9
    assert rows(people.filter("developer_type = 'Organization'"), "developer_login") == [("carol",)]


def test_calendar(spark):
    calendar = dims.dim_date(spark)
    assert calendar.count() == 4018
    sample = {r.date_id: r for r in calendar.filter("date_id IN ('2026-04-25', '2027-01-01', '2026-04-27')").collect()}
    saturday, new_year, monday = (sample[dt.date(*d)] for d in ((2026, 4, 25), (2027, 1, 1), (2026, 4, 27)))
    assert (saturday.day_name, saturday.day_of_week, saturday.is_weekday, saturday.month_name) == ("Sat", 6, False, "Apr")
    assert (new_year.week_of_year, new_year.quarter, new_year.day_of_year) == (53, 1, 1)
    assert (monday.week_start_date, monday.day_of_week, monday.is_weekday) == (dt.date(2026, 4, 27), 1, True)
    assert saturday.week_start_date == dt.date(2026, 4, 20)


def test_dim_repos_and_past_view(history):
    assert rows(snapshot.dim_repos(history), "full_name") == [
        ("alice/awesome-ml",), ("bob/data-pipeline",), ("carol/fastapi-starter",)
    ]
    eleven = F.lit("2026-04-25 11:00:00").cast("timestamp")
    assert rows(snapshot.repos_as_of(history, eleven), "repo_id") == [(100001,), (100002,)]


def test_search(staged):
    day = dt.date(2026, 4, 25)
    found = reports.search_repositories(staged["repositories"], day, day)
    assert [r.repo_id for r in found.collect()] == [100003, 100002, 100001]
    assert reports.search_repositories(staged["repositories"], day, day, min_stars=100).count() == 2
    assert reports.search_repositories(staged["repositories"], day, day, language="Rust").count() == 0
    later = day + dt.timedelta(days=1)
    assert reports.search_repositories(staged["repositories"], later, later).count() == 0


def test_raw_tables_are_read_path_by_path(sample_raw, staged):
    """The scan of a shredded payload takes only the paths a query uses."""
    plan = staged["repositories"].select("repo_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<payload:struct<0:bigint>>" in plan


def test_top_developers_is_a_bounded_sort(history):
    activity = marts.mart_developer_activity(history).withColumnRenamed("repos_created", "repos_count")
    top = reports.top_developers(activity, 2)
    assert [(r.owner_login, r.stars) for r in top.collect()] == [("bob", 347), ("alice", 128)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
