from __future__ import annotations

import copy
import time
from pathlib import Path

import pytest
from samples import raw_of, rows, sample_payloads
from pyspark.sql import functions as F

from forgelens import session
from forgelens.operators.quality import QualityError
from forgelens.plans import build as building
from forgelens.plans import stores
from forgelens.plans.build import build
from forgelens.plans.contracts import TABLE_RULES
from forgelens.plans.facts import FACTS
from forgelens.plans.stores import VersionedTable


def raw_tables(spark, payloads, run="run-1", extracted="2026-04-25T06:00:00"):
    return {r: raw_of(spark, r, p, run, extracted) for r, p in payloads.items()}


def test_clean_samples_pass_every_rule(spark, sample_raw, tmp_path):
    out = build(spark, sample_raw, str(tmp_path), "20260425")
    assert set(out.tables) == set(TABLE_RULES)
    # 99 rules on tables and 36 on the values behind staged columns.
    assert len(out.outcomes) == 135 and all(r.passed for r in out.outcomes)
    assert VersionedTable(spark, f"{tmp_path}/mart_community_health").read().count() == 3
    assert out.quality.filter("severity = 'warn'").count() == 5


def test_a_broken_table_stops_what_depends_on_it(spark, tmp_path):
    payloads = copy.deepcopy(sample_payloads())
    payloads["issues"][0]["state"] = "lost"
    with pytest.raises(QualityError, match="stg_issues.state accepted_values: 1"):
        build(spark, raw_tables(spark, payloads), str(tmp_path), "1")
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, f"{tmp_path}/repos_snapshot").read()


def test_a_failed_build_leaves_the_last_one(spark, tmp_path):
    build(spark, raw_tables(spark, sample_payloads()), str(tmp_path), "1")
    payloads = copy.deepcopy(sample_payloads())
    payloads["repositories"][0]["forks_count"] = -1
    with pytest.raises(QualityError):
        build(spark, raw_tables(spark, payloads), str(tmp_path), "2")
    mart = VersionedTable(spark, f"{tmp_path}/mart_trending_repos").read()
    assert rows(mart, "repo_id", "forks_count") == [(100001, 24), (100002, 61), (100003, 12)]


def test_a_table_that_breaks_its_rules_is_not_shown(spark, tmp_path):
    build(spark, raw_tables(spark, sample_payloads()), str(tmp_path), "1")
    payloads = copy.deepcopy(sample_payloads())
    # Two repositories of one name: fine for staging, not for the dimension.
    payloads["repositories"][1]["full_name"] = payloads["repositories"][0]["full_name"]
    with pytest.raises(QualityError, match="dim_repos.full_name unique: 1"):
        build(spark, raw_tables(spark, payloads), str(tmp_path), "2")
    names = rows(VersionedTable(spark, f"{tmp_path}/dim_repos").read(), "full_name")
    assert names == [("alice/awesome-ml",), ("bob/data-pipeline",), ("carol/fastapi-starter",)]


def test_warnings_do_not_stop(spark, tmp_path):
    payloads = copy.deepcopy(sample_payloads())
    payloads["repositories"][2]["stargazers_count"] = 2
    payloads["issues"][0]["title"] = ""
    out = build(spark, raw_tables(spark, payloads), str(tmp_path), "1")
    assert sorted((r.table_name, r.column_name) for r in out.outcomes if not r.passed) == [
        ("stg_issues", "title"), ("stg_repositories", "stargazers_count")
    ]


def test_runs_advance_the_stored_history(spark, tmp_path):
    def run(tag, payloads):
        raw = raw_tables(spark, payloads, f"run-{tag}", f"2026-04-2{tag}T06:00:00")
        moment = F.lit(f"2026-04-2{tag} 06:00:00").cast("timestamp")
        return build(spark, raw, str(tmp_path), f"2026042{tag}", run_ts=moment)

    first = copy.deepcopy(sample_payloads())
    run(6, first)
    second = copy.deepcopy(first)
    second["repositories"][0] |= {"stargazers_count": 999, "updated_at": "2026-04-26T10:00:00Z"}
    out = run(7, second)
    assert out.tables["repos_snapshot"].count() == 4
    assert rows(out.tables["dim_repos"], "repo_id") == [(100001,), (100002,), (100003,)]
    assert rows(out.tables["mart_trending_repos"].filter("repo_id = 100001"), "stargazers_count") == [(999,)]
    # The same run again is the same state.
    assert run(7, second).tables["repos_snapshot"].count() == 4


def test_a_value_that_does_not_fit_stops_the_build(spark, tmp_path):
    payloads = copy.deepcopy(sample_payloads())
    payloads["pull_requests"][0]["comments"] = "many"
    with pytest.raises(QualityError, match="stg_pull_requests.comments_count fits_type: 1"):
        build(spark, raw_tables(spark, payloads), str(tmp_path), "1")


def test_a_version_that_ends_when_it_starts_is_told(spark, tmp_path):
    first, second = copy.deepcopy(sample_payloads()), copy.deepcopy(sample_payloads())
    second["repositories"][0]["stargazers_count"] += 1
    later = raw_tables(spark, second, "run-2", "2026-04-26T06:00:00")
    both = {r: t.unionByName(later[r]) for r, t in raw_tables(spark, first).items()}
    out = build(spark, both, str(tmp_path), "1")
    (told,) = [r for r in out.outcomes if r.table_name == "repos_snapshot" and not r.passed]
    assert (told.column_name, told.severity, told.n_failed) == ("dbt_valid_to", "warn", 1)


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {file for folder in folders for file in Path(folder).rglob("shuffle_*")}


def test_a_build_leaves_no_shuffles(spark, sample_raw, tmp_path):
    before = shuffle_files(spark)
    build(spark, sample_raw, str(tmp_path), "1")
    # Files are removed in the background.
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.5)
    assert not shuffle_files(spark) - before


def test_shuffles_are_kept_again_after_a_build(spark, tmp_path):
    spark.conf.set(session._RELEASE, "false")
    payloads = copy.deepcopy(sample_payloads())
    payloads["issues"][0]["state"] = "lost"
    with pytest.raises(QualityError):
        build(spark, raw_tables(spark, payloads), str(tmp_path), "1")
    assert spark.conf.get(session._RELEASE) == "false"
    spark.conf.unset(session._RELEASE)


def test_facts_made_in_shares_are_the_same(spark, tmp_path, monkeypatch):
    payloads = copy.deepcopy(sample_payloads())
    for resource, records in payloads.items():
        # Records that come twice, one that comes often and two without an id.
        more = [records[i % 3] | {"id": i} for i in range(30)] + [records[0] | {"comments": i} for i in range(9)]
        payloads[resource] = [*records, *more, *more[:9], records[1] | {"id": None}, records[2] | {"id": None}]
    raw = raw_tables(spark, payloads)
    whole = build(spark, raw, f"{tmp_path}/whole", "1", gate=False)
    written, write = [], stores.write_folder

    def spied(df, path, **how):
        written.append((Path(path).parts[-2], how.get("add", False)))
        write(df, path, **how)

    monkeypatch.setattr(stores, "write_folder", spied)
    monkeypatch.setattr(building, "SHARE_ROWS", 20)
    parted = build(spark, raw, f"{tmp_path}/parted", "1", gate=False)
    assert sorted(map(str, parted.outcomes)) == sorted(map(str, whole.outcomes))
    for name, _ in FACTS.values():
        assert [add for table, add in written if table == name] == [False, True, True]
        one, other = (sorted(map(str, out.tables[name].collect())) for out in (whole, parted))
        assert one == other and len(one) == 34
