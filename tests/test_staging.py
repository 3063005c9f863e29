from __future__ import annotations


import pytest
from samples import moment, raw_of, rows, sample_payloads
from pyspark.sql import functions as F

from forgelens.functions import PayloadReader
from forgelens.plans import staging
from forgelens.plans.staging import stage


def test_column_counts(staged):
    assert [len(staged[r].columns) for r in ("repositories", "pull_requests", "issues")] == [37, 20, 18]


def test_repositories(staged):
    assert rows(staged["repositories"], "repo_id", "owner_type", "stargazers_count", "license_key", "homepage") == [
        (100001, "User", 128, "mit", None),
        (100002, "User", 347, "apache-2.0", None),
        (100003, "Organization", 56, "mit", None),
    ]
    first = staged["repositories"].filter("repo_id = 100001").first()
    assert first.topics == ["python", "tools"]
    assert first.is_fork is False and first.has_pages is None and first.search_score is None
    assert first.airbyte_raw_id is not None


def test_json_null_is_not_merged(staged):
    assert rows(staged["pull_requests"], "pr_id", "is_merged") == [(200001, False), (200002, True), (200003, False)]


def test_repo_name_comes_from_the_url(staged):
    assert rows(staged["issues"], "repo_full_name") == [
        ("alice/awesome-ml",), ("bob/data-pipeline",), ("carol/fastapi-starter",)
    ]


def test_sparse_and_odd_payloads_give_nulls(spark):
    payloads = [
        {"id": 1, "full_name": "user/repo", "stargazers_count": 10},
        {"id": "2", "stargazers_count": "many", "license": None, "owner": None, "created_at": "yesterday"},
        {"id": 3, "created_at": "2026-04-25T10:00:00+02:00", "topics": []},
    ]
    staged = stage(raw_of(spark, "repositories", payloads), "repositories").orderBy("repo_id")
    one, two, three = staged.collect()
    assert (one.repo_id, one.full_name, one.stargazers_count, one.owner_login) == (1, "user/repo", 10, None)
    assert (two.repo_id, two.stargazers_count, two.license_key, two.created_at) == (2, None, None, None)
    assert three.topics == []
    assert staged.filter("repo_id = 3").select(F.unix_seconds("created_at")).first()[0] == int(
        moment("2026-04-25T08:00:00").timestamp()
    )


def test_malformed_payload_gives_nulls(spark):
    raw = raw_of(spark, "issues", [{"id": 1}]).withColumn("payload", F.lit('{"id": 1'))
    assert stage(raw, "issues").first().issue_id is None


def test_unknown_resource_is_refused(spark):
    with pytest.raises(ValueError, match="Unsupported resource"):
        stage(raw_of(spark, "comments", [{"id": 1}]), "comments")


def test_every_payload_form_stages_the_same(spark):
    payloads = sample_payloads()["pull_requests"]
    text = raw_of(spark, "pull_requests", payloads)
    shape = (
        "struct<id:bigint,number:bigint,title:string,user:struct<login:string,id:bigint>,state:string,"
        "created_at:string,updated_at:string,closed_at:string,comments:bigint,repository_url:string,"
        "pull_request:struct<merged_at:string>>"
    )
    struct = text.withColumn("payload", F.from_json("payload", shape))
    flat = struct.select(
        *[c for c in struct.columns if c != "payload"],
        *[
            F.col(f"payload.{path}").alias(f"payload.{path}")
            for path in (
                "id number title state created_at updated_at closed_at comments repository_url "
                "user.login user.id pull_request.merged_at"
            ).split()
        ],
    )
    variant = text.withColumn("payload", F.parse_json("payload"))
    expected = sorted(map(str, stage(text, "pull_requests").collect()))
    for form in (struct, flat, variant):
        assert sorted(map(str, stage(form, "pull_requests").collect())) == expected


def test_payload_of_another_type_is_refused(spark):
    with pytest.raises(TypeError):
        PayloadReader(spark.range(1).withColumnRenamed("id", "payload"))
    with pytest.raises(TypeError):
        PayloadReader(spark.range(1))




def test_values_that_do_not_fit_are_counted(spark):
    lines = ['{"id": 1, "comments": "many", "user": {"id": 7}}', '{"id": 2, "comments": null}', '{"id": "x", "comments": 3}', "no"]
    raw = spark.createDataFrame([(line,) for line in lines], "payload STRING")
    found = {r["column_name"]: (r["rows"], r["misfits"]) for r in staging.misfits(raw, "issues").collect()}
    assert found["comments_count"] == (4, 1) and found["issue_id"] == (4, 1) and found["author_id"] == (4, 0)
