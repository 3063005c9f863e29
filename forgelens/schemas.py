"""Record shapes.  Nothing in this package infers a schema."""

from __future__ import annotations

RESOURCES = ("repositories", "pull_requests", "issues")

# One landed record, as JSON lines.
ENVELOPE = "_resource STRING, _run_id STRING, _extracted_at TIMESTAMP, payload VARIANT"
ENVELOPE_PARTS = ("_resource", "_run_id", "_extracted_at", "payload")
CORRUPT_COLUMN = "_corrupt_record"
PARTITIONS = ("year", "month", "day")

# Columns the loader adds to every raw row.
RAW_ID = "_airbyte_raw_id"
LOADED_AT = "_airbyte_extracted_at"

# Payload path and type of every staged column, per resource.
STAGED = {
    "repositories": {
        "repo_id": ("id", "bigint"),
        "node_id": ("node_id", "string"),
        "repo_name": ("name", "string"),
        "full_name": ("full_name", "string"),
        "owner_login": ("owner.login", "string"),
        "owner_id": ("owner.id", "bigint"),
        "owner_type": ("owner.type", "string"),
        "description": ("description", "string"),
        "html_url": ("html_url", "string"),
        "homepage": ("homepage", "string"),
        "language": ("language", "string"),
        "topics": ("topics", "array<string>"),
        "visibility": ("visibility", "string"),
        "default_branch": ("default_branch", "string"),
        "license_key": ("license.key", "string"),
        "license_name": ("license.name", "string"),
        "is_fork": ("fork", "boolean"),
        "is_archived": ("archived", "boolean"),
        "is_disabled": ("disabled", "boolean"),
        "is_private": ("private", "boolean"),
        "has_issues": ("has_issues", "boolean"),
        "has_wiki": ("has_wiki", "boolean"),
        "has_discussions": ("has_discussions", "boolean"),
        "has_pages": ("has_pages", "boolean"),
        "stargazers_count": ("stargazers_count", "bigint"),
        "watchers_count": ("watchers_count", "bigint"),
        "forks_count": ("forks_count", "bigint"),
        "open_issues_count": ("open_issues_count", "bigint"),
        "size_kb": ("size", "bigint"),
        "search_score": ("score", "double"),
        "created_at": ("created_at", "timestamp"),
        "updated_at": ("updated_at", "timestamp"),
        "pushed_at": ("pushed_at", "timestamp"),
    },
    "pull_requests": {
        "pr_id": ("id", "bigint"),
        "pr_number": ("number", "bigint"),
        "node_id": ("node_id", "string"),
        "title": ("title", "string"),
        "state": ("state", "string"),
        "repository_url": ("repository_url", "string"),
        "author_login": ("user.login", "string"),
        "author_id": ("user.id", "bigint"),
        "comments_count": ("comments", "bigint"),
        "search_score": ("score", "double"),
        "created_at": ("created_at", "timestamp"),
        "updated_at": ("updated_at", "timestamp"),
        "closed_at": ("closed_at", "timestamp"),
        "merged_at": ("pull_request.merged_at", "timestamp"),
    },
    "issues": {
        "issue_id": ("id", "bigint"),
        "issue_number": ("number", "bigint"),
        "node_id": ("node_id", "string"),
        "title": ("title", "string"),
        "state": ("state", "string"),
        "repository_url": ("repository_url", "string"),
        "author_login": ("user.login", "string"),
        "author_id": ("user.id", "bigint"),
        "comments_count": ("comments", "bigint"),
        "search_score": ("score", "double"),
        "created_at": ("created_at", "timestamp"),
        "updated_at": ("updated_at", "timestamp"),
        "closed_at": ("closed_at", "timestamp"),
    },
}

# Repository columns whose change opens a new version.
WATCHED = (
    "stargazers_count",
    "forks_count",
    "open_issues_count",
    "language",
    "description",
    "topics",
    "is_archived",
    "is_disabled",
    "has_issues",
    "has_wiki",
    "has_discussions",
)

# The columns a version adds to its staged row.
VERSION_ID = "dbt_scd_id"
VERSION_UPDATED = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"

# Processed stream records; the bool says whether the field is required.
TRENDING_RECORD = {
    "repo_id": ("bigint", True),
    "full_name": ("string", True),
    "owner_login": ("string", False),
    "language": ("string", False),
    "stargazers_count": ("bigint", True),
    "forks_count": ("bigint", True),
    "open_issues_count": ("bigint", True),
    "star_tier": ("string", True),
    "event_time": ("timestamp", True),
}
DEVELOPER_RECORD = {
    "owner_login": ("string", True),
    "owner_type": ("string", False),
    "repos_count": ("bigint", True),
    "total_stars": ("bigint", True),
    "total_forks": ("bigint", True),
    "primary_language": ("string", False),
    "event_time": ("timestamp", True),
}
