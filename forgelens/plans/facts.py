"""Fact tables: one row per record and extraction run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hour_boundaries, surrogate_key
from ..operators import latest_by
from .snapshot import TIES


def _date(column: str) -> Column:
    return F.to_date(column)


def fact_repo_snapshots(repositories: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Metrics of each repository at each run; the last extraction of a run counts."""
    measures = ["stargazers_count", "watchers_count", "forks_count", "open_issues_count", "size_kb", "search_score"]
    rows = repositories.select("repo_id", "run_id", "full_name", "owner_id", "extracted_at", *measures, *TIES, *keep)
    return latest_by(rows, ["repo_id", "run_id"], "extracted_at", TIES).select(
        surrogate_key("repo_id", "run_id").alias("snapshot_id"),
        surrogate_key("repo_id").alias("repo_key"),
        surrogate_key("owner_id").alias("developer_key"),
        _date("extracted_at").alias("date_key"),
        "repo_id",
        "run_id",
        "full_name",
        "owner_id",
        "extracted_at",
        _date("extracted_at").alias("snapshot_date"),
        *measures,
        *keep,
    )


def _fact_of_written(staged: DataFrame, record: str, outcome: list[str], keep: Sequence[str]) -> DataFrame:
    """Shared shape of pull requests and issues; ``outcome`` names the columns only one has."""
    extra = [c for c in outcome if c in staged.columns]
    rows = staged.select(
        f"{record}_id",
        f"{record}_number",
        "node_id",
        "run_id",
        "repo_full_name",
        "author_login",
        "author_id",
        "title",
        "state",
        *extra,
        "comments_count",
        "search_score",
        "created_at",
        "updated_at",
        "closed_at",
        *TIES,
        *keep,
    )
    single = latest_by(rows, [f"{record}_id", "run_id"], "created_at", TIES)
    fact = single.select(
        surrogate_key(f"{record}_id", "run_id").alias(f"{record}_snapshot_id"),
        surrogate_key("author_id").alias("developer_key"),
        _date("created_at").alias("date_key"),
        *[c for c in rows.columns if c not in TIES],
        _date("created_at").alias("created_date"),
        _date("closed_at").alias("closed_date"),
        # NULL when either end is unknown.
        hour_boundaries(F.col("created_at"), F.col("closed_at")).alias("hours_to_close"),
    )
    return fact.withColumn("merged_date", _date("merged_at")) if "merged_at" in extra else fact


def fact_pull_requests(pull_requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _fact_of_written(pull_requests, "pr", ["is_merged", "merged_at"], keep)


def fact_issues(issues: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _fact_of_written(issues, "issue", [], keep)


# The fact table of each resource.
FACTS = {
    "repositories": ("fact_repo_snapshots", fact_repo_snapshots),
    "pull_requests": ("fact_pull_requests", fact_pull_requests),
    "issues": ("fact_issues", fact_issues),
}
# The record a row of each resource is about.
RECORDS = {"repositories": "repo_id", "pull_requests": "pr_id", "issues": "issue_id"}


def shares(staged: DataFrame, resource: str, count: int) -> list[DataFrame]:
    """The rows in ``count`` shares, in one of which all rows of a record and run are."""
    if count < 2:
        return [staged]
    place = F.pmod(F.xxhash64(RECORDS[resource], "run_id"), F.lit(count))
    return [staged.filter(place == i) for i in range(count)]
