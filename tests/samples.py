"""Sample records and small helpers that several test modules share."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

UTC = dt.timezone.utc


def moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


# The nine sample records, reduced to what the goldens rest on.
RUN = "aaaaaaaa-0000-0000-0000-000000000001"
EXTRACTED = "2026-04-25T06:00:00+00:00"
REPOS = [
    # id, owner, owner id, owner type, name, stars, forks, created, updated, wiki, discussions, license
    (100001, "alice", 1001, "User", "awesome-ml", 128, 24, "08:00", "10:00", True, False, "mit"),
    (100002, "bob", 1002, "User", "data-pipeline", 347, 61, "05:30", "11:00", True, True, "apache-2.0"),
    (100003, "carol", 1003, "Organization", "fastapi-starter", 56, 12, "07:00", "12:00", False, False, "mit"),
]
WRITTEN = [
    # id, author id, repo, comments, created, closed, merged
    ("pull_requests", 200001, 2001, "alice/awesome-ml", 3, "08:00", None, False),
    ("pull_requests", 200002, 2002, "bob/data-pipeline", 5, "06:00", "09:00", True),
    ("pull_requests", 200003, 2003, "carol/fastapi-starter", 1, "07:00", None, False),
    ("issues", 300001, 3001, "alice/awesome-ml", 2, "08:00", None, False),
    ("issues", 300002, 3002, "bob/data-pipeline", 4, "06:00", "09:00", False),
    ("issues", 300003, 3003, "carol/fastapi-starter", 0, "07:00", None, False),
]


def at(clock: str | None) -> str | None:
    return clock and f"2026-04-25T{clock}:00Z"


def sample_payloads() -> dict[str, list[dict]]:
    payloads: dict[str, list[dict]] = {"repositories": [], "pull_requests": [], "issues": []}
    for key, owner, owner_id, kind, name, stars, forks, created, updated, wiki, talks, key_of_license in REPOS:
        payloads["repositories"].append(
            {
                "id": key,
                "name": name,
                "full_name": f"{owner}/{name}",
                "owner": {"login": owner, "id": owner_id, "type": kind},
                "description": None,
                "language": "Python",
                "stargazers_count": stars,
                "watchers_count": stars,
                "forks_count": forks,
                "open_issues_count": 5,
                "size": 100,
                "topics": ["python", "tools"],
                "visibility": "public",
                "private": False,
                "fork": False,
                "archived": False,
                "disabled": False,
                "has_issues": True,
                "has_wiki": wiki,
                "has_discussions": talks,
                "license": {"key": key_of_license, "name": key_of_license},
                "homepage": None,
                "created_at": at(created),
                "updated_at": at(updated),
                "pushed_at": at(updated),
            }
        )
    for resource, key, author, repo, comments, created, closed, merged in WRITTEN:
        record = {
            "id": key,
            "number": key % 1000,
            "title": f"record {key}",
            "user": {"login": f"user{author}", "id": author, "type": "User"},
            "state": "closed" if closed else "open",
            "created_at": at(created),
            "updated_at": at(closed or created),
            "closed_at": at(closed),
            "comments": comments,
            "repository_url": f"https://api.example.org/repos/{repo}",
        }
        if resource == "pull_requests":
            record["pull_request"] = {"merged_at": at(closed) if merged else None}
        payloads[resource].append(record)
    return payloads


def envelope_lines(resource: str, payloads: list[dict], run: str = RUN, extracted: str = EXTRACTED) -> list[str]:
    return [
        json.dumps({"_resource": resource, "_run_id": run, "_extracted_at": extracted, "payload": p}) for p in payloads
    ]


def write_lines(folder: Path, lines: list[str], name: str = "part-00001.jsonl") -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def raw_of(spark, resource: str, payloads: list[dict], run: str = RUN, extracted: str = EXTRACTED):
    """A raw table whose payload is JSON text."""
    rows = [
        (resource, run, moment(extracted[:19]), f"raw-{run}-{i}", moment(extracted[:19]), json.dumps(p))
        for i, p in enumerate(payloads)
    ]
    columns = (
        "_resource STRING, _run_id STRING, _extracted_at TIMESTAMP, _airbyte_raw_id STRING, "
        "_airbyte_extracted_at TIMESTAMP, payload STRING"
    )
    return spark.createDataFrame(rows, columns)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
