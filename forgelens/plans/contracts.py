"""The rules every table has to meet."""

from __future__ import annotations

from ..operators.quality import (
    Rule,
    accepted_values,
    between,
    column_exists,
    fits_type,
    is_true,
    length_between,
    not_null,
    references,
    row_count,
    unique,
)
from ..schemas import RESOURCES
from .staging import typed_columns

# Allowed words and limits.
STATES = ("open", "closed")
VISIBILITIES = ("public", "private", "internal")
TIERS = ("high", "medium", "low", "minimal")
TITLE_LENGTH = (1, 500)
SEARCHED_MIN_STARS = 5
SEARCHED_LANGUAGES = ("Python",)


def _required(*columns: str) -> list[Rule]:
    return [not_null(c) for c in columns]


def _keys(*columns: str) -> list[Rule]:
    return [rule(c) for c in columns for rule in (not_null, unique)]


def _counts(*columns: str) -> list[Rule]:
    return [is_true(c, ">= 0") for c in columns]


def _staged_written(key: str) -> list[Rule]:
    return [
        *_required("airbyte_raw_id", key, "state", "author_login"),
        accepted_values("state", STATES),
        length_between("title", *TITLE_LENGTH, severity="warn"),
        *_counts("comments_count"),
    ]


def _fact_written(key: str) -> list[Rule]:
    return [
        *_keys(key),
        *_required("developer_key", "date_key"),
        references("developer_key", "dim_developers", "developer_key"),
        references("date_key", "dim_date", "date_id"),
        accepted_values("state", STATES),
        is_true("hours_to_close", ">= 0", where="hours_to_close IS NOT NULL"),
    ]


def _raw_written() -> list[Rule]:
    return [column_exists("id"), *_required("id", "title"), accepted_values("state", STATES)]


# What the payloads have to look like before anything is loaded.
SOURCE_RULES: dict[str, list[Rule]] = {
    "repositories": [
        *[column_exists(c) for c in ("id", "full_name", "stargazers_count")],
        *_required("id", "full_name"),
        between("stargazers_count", low=SEARCHED_MIN_STARS),
        accepted_values("language", SEARCHED_LANGUAGES),
        row_count(low=1),
    ],
    "pull_requests": _raw_written(),
    "issues": [*_raw_written(), between("comments", low=0)],
}

TABLE_RULES: dict[str, list[Rule]] = {
    "stg_repositories": [
        row_count(low=1),
        *_required("airbyte_raw_id", "repo_id", "full_name", "owner_login", "stargazers_count"),
        accepted_values("visibility", VISIBILITIES),
        between("stargazers_count", low=SEARCHED_MIN_STARS, severity="warn"),
        *_counts("stargazers_count", "forks_count"),
    ],
    "stg_pull_requests": _staged_written("pr_id"),
    "stg_issues": _staged_written("issue_id"),
    "repos_snapshot": [
        *_required("repo_id", "full_name", "dbt_valid_from"),
        *_keys("dbt_scd_id"),
        *_counts("stargazers_count", "forks_count"),
        # A watched column moved, the change time did not.
        is_true("dbt_valid_to", "> dbt_valid_from", severity="warn"),
    ],
    "dim_repos": [*_keys("repo_key", "repo_id", "full_name"), *_required("owner_login")],
    "dim_developers": [*_keys("developer_key", "developer_id"), *_required("developer_login")],
    "dim_date": [*_keys("date_id"), is_true("year", ">= 2020")],
    "fact_repo_snapshots": [
        *_keys("snapshot_id"),
        *_required("repo_key", "developer_key", "date_key"),
        references("repo_key", "dim_repos", "repo_key"),
        references("developer_key", "dim_developers", "developer_key"),
        references("date_key", "dim_date", "date_id"),
        *_counts("stargazers_count", "forks_count"),
    ],
    "fact_pull_requests": _fact_written("pr_snapshot_id"),
    "fact_issues": _fact_written("issue_snapshot_id"),
    "mart_trending_repos": [
        row_count(low=1),
        *_keys("repo_id"),
        *_required("full_name", "stargazers_count", "forks_count", "star_tier"),
        *_counts("stargazers_count", "forks_count"),
        accepted_values("star_tier", TIERS),
    ],
    "mart_developer_activity": [
        row_count(low=1),
        *_keys("owner_login"),
        *_required("repos_created"),
        is_true("repos_created", ">= 1"),
        *_counts("total_stars", "avg_stars_per_repo"),
    ],
    "mart_community_health": [
        row_count(low=1),
        *_keys("repo_id"),
        *_required("full_name", "health_score"),
        between("health_score", low=0, high=100),
        *_counts("tracked_issues", "tracked_prs"),
        between("pr_merge_rate_pct", low=0, high=100, severity="warn"),
    ],
}

# Rules on the payload values behind a staged table, which staging flags on request.
CAST_RULES: dict[str, list[Rule]] = {
    f"stg_{resource}": [fits_type(column) for column in typed_columns(resource)] for resource in RESOURCES
}
