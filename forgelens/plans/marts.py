"""Marts over the open versions of the repository history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_boundaries, percent, star_tier
from ..operators import current, latest_by
from .snapshot import TIES

# Columns the trending mart takes over as they are.
TRENDING_COLUMNS = (
    "repo_id full_name repo_name owner_login language description homepage topics visibility license_key "
    "default_branch stargazers_count watchers_count forks_count open_issues_count size_kb is_fork is_archived "
    "has_issues has_wiki has_discussions created_at updated_at pushed_at"
).split()

# Points of the health score.
HEALTH_POINTS = {
    "has_issues": 10,
    "has_wiki": 10,
    "has_discussions": 10,
    "has_license": 20,
    "has_stars": 10,
    "tracks_issues": 20,
    "tracks_prs": 20,
}
HEALTH_MAXIMUM = 100


def mart_trending_repos(history: DataFrame) -> DataFrame:
    """Live repositories with their tier; one with an unknown flag is left out."""
    live = current(history).filter(~F.col("is_archived") & ~F.col("is_disabled"))
    return live.select(
        *TRENDING_COLUMNS,
        F.date_trunc("day", "created_at").alias("created_date"),
        F.date_trunc("week", "created_at").alias("created_week"),
        day_boundaries(F.col("created_at"), F.col("updated_at")).cast("bigint").alias("days_since_creation"),
        star_tier(F.col("stargazers_count")).alias("star_tier"),
    )


def mart_developer_activity(history: DataFrame) -> DataFrame:
    """Totals per owner.

    Aggregated in two steps, first per (owner, language) and then per owner.
    The distinct count, the sorted language list and the most used language
    then come from one row per language, and an owner that holds a third of
    all repositories reaches its reducer as a few pre-aggregated rows.
    """
    owner = ["owner_login", "owner_id", "owner_type"]
    per_language = (
        current(history)
        .filter(F.col("owner_login").isNotNull())
        .groupBy(*owner, "language")
        .agg(
            F.count("*").alias("repos"),
            F.count_if(~F.col("is_fork")).alias("originals"),
            F.count_if("is_fork").alias("forks"),
            F.sum("stargazers_count").alias("stars"),
            F.count("stargazers_count").alias("starred"),
            F.sum("forks_count").alias("fork_total"),
            F.sum("open_issues_count").alias("issue_total"),
            F.min("created_at").alias("first"),
            F.max("created_at").alias("last"),
        )
    )
    # Highest count first, then alphabetical; repositories without a language do not vote.
    vote = F.when(F.col("language").isNotNull(), F.struct((-F.col("repos")).alias("n"), "language"))
    return (
        per_language.groupBy(*owner)
        .agg(
            F.sum("repos").alias("repos_created"),
            F.sum("originals").alias("original_repos"),
            F.sum("forks").alias("forked_repos"),
            F.sum("stars").alias("total_stars"),
            F.sum("fork_total").alias("total_forks"),
            F.sum("issue_total").alias("total_open_issues"),
            F.sum("starred").alias("starred"),
            F.sort_array(F.collect_list("language")).alias("languages_used"),
            F.min(vote)["language"].alias("primary_language"),
            F.min("first").alias("first_repo_at"),
            F.max("last").alias("latest_repo_at"),
        )
        .select(
            *owner,
            "repos_created",
            "original_repos",
            "forked_repos",
            "total_stars",
            "total_forks",
            "total_open_issues",
            F.when(F.col("starred") > 0, F.col("total_stars") / F.col("starred")).alias("avg_stars_per_repo"),
            F.size("languages_used").cast("bigint").alias("distinct_languages"),
            "languages_used",
            "primary_language",
            "first_repo_at",
            "latest_repo_at",
            day_boundaries(F.col("first_repo_at"), F.col("latest_repo_at")).cast("bigint").alias("active_days_span"),
        )
    )


def _counts(staged: DataFrame, key: str, dedup: bool, **measures: Column) -> DataFrame:
    """Per repository name, whatever its letter case, so that the join cannot fan out."""
    if dedup:
        staged = latest_by(staged, [key], "extracted_at", TIES)
    return staged.groupBy(F.lower("repo_full_name").alias("__name")).agg(
        F.count("*").alias("total"), F.avg("comments_count").alias("avg_comments"), *[m.alias(n) for n, m in measures.items()]
    )


def mart_community_health(
    history: DataFrame, issues: DataFrame, pull_requests: DataFrame, dedup: bool = False
) -> DataFrame:
    """Issue and pull-request health per repository.

    Both feeds are reduced to one row per repository before they meet it.
    They are counted as delivered, so a record seen in two runs counts twice;
    ``dedup=True`` counts the latest state of each record once.
    """
    is_open, is_closed = F.col("state") == "open", F.col("state") == "closed"
    i = _counts(issues, "issue_id", dedup, open=F.count_if(is_open), closed=F.count_if(is_closed)).alias("i")
    p = _counts(pull_requests, "pr_id", dedup, merged=F.count_if("is_merged"), open=F.count_if(is_open)).alias("p")
    name = F.lower("r.full_name")
    joined = (
        current(history)
        .alias("r")
        .join(i, name == F.col("i.__name"), "left")
        .join(p, name == F.col("p.__name"), "left")
    )

    def known(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    earned = {
        "has_issues": F.col("r.has_issues"),
        "has_wiki": F.col("r.has_wiki"),
        "has_discussions": F.col("r.has_discussions"),
        "has_license": F.col("r.license_key").isNotNull(),
        "has_stars": F.col("r.stargazers_count") > 0,
        "tracks_issues": F.col("i.total") > 0,
        "tracks_prs": F.col("p.total") > 0,
    }
    score = sum((F.when(earned[n], points).otherwise(0) for n, points in HEALTH_POINTS.items()), F.lit(0))
    return joined.select(
        *[
            f"r.{c}"
            for c in (
                "repo_id full_name owner_login language stargazers_count forks_count open_issues_count "
                "has_issues has_wiki has_discussions license_key created_at"
            ).split()
        ],
        known("i.total").alias("tracked_issues"),
        known("i.open").alias("tracked_open_issues"),
        known("i.closed").alias("tracked_closed_issues"),
        known("i.avg_comments").alias("avg_issue_comments"),
        known("p.total").alias("tracked_prs"),
        known("p.merged").alias("merged_prs"),
        known("p.open").alias("open_prs"),
        known("p.avg_comments").alias("avg_pr_comments"),
        percent(F.col("i.closed"), F.col("i.total")).alias("issue_close_rate_pct"),
        percent(F.col("p.merged"), F.col("p.total")).alias("pr_merge_rate_pct"),
        F.least(F.lit(HEALTH_MAXIMUM), score).alias("health_score"),
    )
