"""Reports over marts, facts and dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import asof_join, latest_by

# What the extraction search asks for.
SEARCH_LANGUAGE = "Python"
SEARCH_MIN_STARS = 5
TOP_DEVELOPERS = 10


def trending_by_tier(trending: DataFrame) -> DataFrame:
    """Repositories and average stars per tier, best tier first."""
    return (
        trending.groupBy("star_tier")
        .agg(F.count("*").alias("repos"), F.avg("stargazers_count").alias("avg_stars"))
        .orderBy(F.col("avg_stars").desc_nulls_last(), "star_tier")
    )


def top_developers(activity: DataFrame, limit: int = TOP_DEVELOPERS) -> DataFrame:
    """The owners with the most stars.  ``activity`` has repos_count and total_stars per row."""
    return (
        activity.groupBy("owner_login")
        .agg(F.sum("repos_count").alias("repos"), F.sum("total_stars").alias("stars"))
        .orderBy(F.col("stars").desc_nulls_last(), "owner_login")
        .limit(limit)
    )


def search_repositories(
    repositories: DataFrame,
    created_from: dt.date,
    created_to: dt.date,
    language: str = SEARCH_LANGUAGE,
    min_stars: int = SEARCH_MIN_STARS,
) -> DataFrame:
    """Repositories of one language created in a range of days, last updated first.

    The bounds are compared with the timestamp itself, so they can reach the
    scan; the id in the sort order also splits ties over range partitions.
    """
    start = dt.datetime.combine(created_from, dt.time())
    end = dt.datetime.combine(created_to + dt.timedelta(days=1), dt.time())
    created = F.col("created_at")
    return repositories.filter(
        (created >= F.lit(start.isoformat(" ")).cast("timestamp"))
        & (created < F.lit(end.isoformat(" ")).cast("timestamp"))
        & (F.col("language") == language)
        & (F.col("stargazers_count") >= min_stars)
    ).orderBy(F.col("updated_at").desc_nulls_last(), "repo_id")


def metrics_over_time(snapshots: DataFrame, history: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Totals per snapshot day and language, each snapshot with the version valid at its time.

    Every snapshot counts: one without a version has no language, and a day
    beyond the calendar has no attributes.
    """
    versions = history.select("repo_id", "dbt_valid_from", "dbt_valid_to", "language")
    measures = ["stargazers_count", "forks_count", "open_issues_count"]
    joined = asof_join(
        snapshots.select("repo_id", "extracted_at", "date_key", *measures),
        versions,
        "repo_id",
        "extracted_at",
        "dbt_valid_from",
        "dbt_valid_to",
    )
    daily = joined.groupBy("date_key", "language").agg(
        F.count("*").alias("repos"),
        F.sum("stargazers_count").alias("stars"),
        F.sum("forks_count").alias("forks"),
        F.sum("open_issues_count").alias("open_issues"),
    )
    calendar = dim_date.select("date_id", "year", "week_of_year", "day_name", "is_weekday")
    return daily.join(calendar, F.col("date_key") == F.col("date_id"), "left").select(
        "date_key", "year", "week_of_year", "day_name", "is_weekday", "language", "repos", "stars", "forks", "open_issues"
    )


def pull_requests_by_day(pull_requests: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every day of the calendar with its attributes and the pull requests opened on it.

    The calendar has a fixed number of rows, and the facts are reduced to one
    row per day before they meet it.  Days beyond it, and requests without a
    day, have rows without attributes.
    """
    daily = pull_requests.groupBy("date_key").agg(
        F.count("*").alias("opened"),
        F.count_if("is_merged").alias("merged"),
        F.sum("hours_to_close").alias("hours"),
        F.count("hours_to_close").alias("closed"),
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("opened", "merged", "closed")]
    average = F.when(F.col("closed") > 0, F.col("hours") / F.col("closed"))
    columns = [F.coalesce("date_id", "date_key").alias("date_id"), *[c for c in dim_date.columns if c != "date_id"]]
    return dim_date.join(daily, F.col("date_id") == F.col("date_key"), "full_outer").select(
        *columns, *counts, average.alias("avg_hours_to_close")
    )


def pull_requests_by_owner(pull_requests: DataFrame, dim_repos: DataFrame) -> DataFrame:
    """Pull requests per owner type and language of their repository, by name in any letter case.

    Requests of repositories that are not listed have a row of their own.  Of
    several repositories of one name the one updated last counts.
    """
    per_repo = pull_requests.groupBy(F.lower("repo_full_name").alias("name")).agg(
        F.count("*").alias("prs"), F.count_if("is_merged").alias("merged")
    )
    named = dim_repos.filter(F.col("full_name").isNotNull()).withColumn("listed_name", F.lower("full_name"))
    one = latest_by(named, ["listed_name"], "updated_at", ["repo_id"]).select(
        "listed_name", "owner_type", "language", F.lit(True).alias("listed")
    )
    return (
        per_repo.join(one, F.col("name") == F.col("listed_name"), "left")
        .groupBy(F.coalesce("listed", F.lit(False)).alias("is_listed"), "owner_type", "language")
        .agg(F.count("*").alias("repos"), F.sum("prs").alias("prs"), F.sum("merged").alias("merged"))
    )
