from __future__ import annotations

import datetime as dt
import json

import pytest
from samples import envelope_lines, moment, rows, write_lines
from pyspark.sql import functions as F

from forgelens.plans import jobs
from forgelens.plans.staging import stage
from forgelens.sources import landing
from forgelens.sources.sliced import SlicedTable

DAY = dt.date(2026, 5, 17)


def items(spark, ids, **extra):
    frame = spark.createDataFrame([(i, f"t{i}") for i in ids], "id BIGINT, title STRING")
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame


def envelopes(spark, ids, run="run-1", at="2026-05-17T06:00:00"):
    return landing.envelopes(items(spark, ids, body=None), "issues", run, moment(at))


def test_lines_carry_the_envelope_and_keep_nulls(spark, tmp_path):
    landing.write(envelopes(spark, [1]), str(tmp_path), "issues")
    (path,) = tmp_path.glob("issues/year=2026/month=05/day=17/*.json")
    record = json.loads(path.read_text())
    assert record["_resource"] == "issues" and record["_run_id"] == "run-1"
    assert record["_extracted_at"] == "2026-05-17T06:00:00.000000+00:00"
    assert record["payload"] == {"id": 1, "title": "t1", "body": None}


def test_a_repeated_day_replaces_itself_only(spark, tmp_path):
    base = str(tmp_path)
    landing.write(envelopes(spark, [1, 2]), base, "issues")
    landing.write(envelopes(spark, [3], at="2026-05-18T06:00:00"), base, "issues")
    landing.write(envelopes(spark, [1, 4, 5], run="run-2"), base, "issues")
    read = landing.read(spark, base, "issues")
    found = rows(read, "day", F.variant_get("payload", "$.id", "int"))
    assert found == [(17, 1), (17, 4), (17, 5), (18, 3)]


def test_run_scoped_landing_keeps_every_run(spark, tmp_path):
    base = str(tmp_path)
    for run in ("run-1", "run-2"):
        landing.write(envelopes(spark, [1, 2], run=run), base, "issues", run_scoped=True)
    manifest = landing.manifest(landing.read_tree(spark, f"{base}/issues"))
    assert rows(manifest, "resource", "run_id", "date", "records") == [
        ("issues", "run-1", DAY, 2), ("issues", "run-2", DAY, 2)
    ]


def test_a_range_of_days_reads_only_its_folders(spark, tmp_path):
    base = str(tmp_path)
    for n in range(4):
        landing.write(envelopes(spark, [n], at=f"2026-05-{17 + n}T06:00:00"), base, "issues")
    part = landing.read(spark, base, "issues", DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=2))
    assert rows(part, "day") == [(18,), (19,)]
    assert len(part.inputFiles()) == 4  # of the whole table
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in scan.split("PartitionFilters:")[1].split("]")[0]


def test_broken_lines_are_kept_apart(spark, tmp_path):
    good = envelope_lines("issues", [{"id": 1, "title": "a"}])
    write_lines(tmp_path / "issues" / "year=2026" / "month=05" / "day=17", [*good, '{"_resource": "issues", "payl'])
    read = landing.read(spark, str(tmp_path), "issues").cache()
    fine, broken = landing.split_corrupt(read)
    assert fine.count() == 1
    assert [r._corrupt_record for r in broken.collect()] == ['{"_resource": "issues", "payl']
    staged = stage(landing.to_raw(landing.read(spark, str(tmp_path), "issues"), F.lit("2026-05-17 06:30:00")), "issues")
    assert rows(staged, "issue_id", "title") == [(1, "a")]


def test_payload_loader_takes_wrapped_and_bare_records(spark, tmp_path):
    lines = [json.dumps({"payload": {"id": 1}}), "", json.dumps({"id": 2})]
    path = write_lines(tmp_path / "f", lines)
    loaded = landing.read_payloads(spark, path)
    assert rows(loaded, F.variant_get("payload", "$.id", "int")) == [(1,), (2,)]


def test_unknown_resource_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported resource"):
        landing.read(spark, str(tmp_path), "comments")
    with pytest.raises(ValueError, match="Unsupported resource"):
        jobs.land_day({}, DAY, str(tmp_path), "r", moment("2026-05-17T06:00:00"), ["comments"])


def test_a_day_is_deduplicated_landed_loaded_and_repeatable(spark, tmp_path):
    base, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    pages = spark.createDataFrame(
        [(1, "a", 1, 0), (2, "b", 1, 1), (1, "late", 2, 0)], "id BIGINT, title STRING, page INT, position INT"
    )
    fetched = {"repositories": pages, "pull_requests": items(spark, [100]), "issues": items(spark, [200])}
    for _ in range(2):
        manifest = jobs.land_day(fetched, DAY, base, "run-1", moment("2026-05-18T01:00:00"))
        assert rows(manifest, "resource", "date", "records") == [
            ("issues", DAY, 1), ("pull_requests", DAY, 1), ("repositories", DAY, 2)
        ]
        jobs.load_days(spark, base, raw, DAY, DAY, F.lit("2026-05-18 02:00:00"))
    tables = jobs.raw_tables(spark, raw)
    assert {r: t.count() for r, t in tables.items()} == {"repositories": 2, "pull_requests": 1, "issues": 1}
    titles = tables["repositories"].select(F.variant_get("payload", "$.title", "string"))
    assert sorted(r[0] for r in titles.collect()) == ["a", "b"]
    ids = {r[0] for r in tables["repositories"].select("_airbyte_raw_id").collect()}
    assert len(ids) == 2 and set(SlicedTable(spark, f"{raw}/repositories").state()) == {DAY}


def test_daily_partitions_include_today(spark):
    days = jobs.daily_partitions(dt.date(2026, 5, 20))
    assert days[0] == dt.date(2026, 5, 17) and days[-1] == dt.date(2026, 5, 20) and len(days) == 4


def test_loading_sets_broken_lines_aside(spark, tmp_path):
    good = envelope_lines("issues", [{"id": 1, "title": "a"}, {"id": 2, "title": "b"}])
    write_lines(tmp_path / "in" / "issues" / "year=2026" / "month=05" / "day=17", [good[0], "{oops", good[1], '{"_resource": "issues"}'])
    raw = str(tmp_path / "raw")
    counts = jobs.load_days(spark, str(tmp_path / "in"), raw, DAY, DAY, F.lit("2026-05-18 02:00:00"), ["issues"])
    assert counts == {"issues": 2}
    assert landing.read_raw(spark, f"{raw}/issues").count() == 2
    aside = landing.read_quarantine(spark, f"{raw}/issues")
    assert rows(aside.fillna(""), "line", "_resource", "landed_on") == [("", "issues", DAY), ("{oops", "", DAY)]


def test_an_emptied_day_is_landed_and_loaded_empty(spark, tmp_path):
    base, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    late = dt.date(2026, 5, 18)
    for day in (DAY, late):
        jobs.land_day({"issues": items(spark, [1, 2, 2])}, day, base, "run-1", moment("2026-05-18T01:00:00"), ["issues"])
    jobs.load_days(spark, base, raw, DAY, late, F.lit("2026-05-18 02:00:00"), ["issues"])
    assert landing.read_raw(spark, f"{raw}/issues").count() == 4
    manifest = jobs.land_day({"issues": items(spark, [])}, DAY, base, "run-2", moment("2026-05-18T03:00:00"), ["issues"])
    assert rows(manifest, "run_id", "date", "records") == [("run-2", DAY, 0)]
    jobs.load_days(spark, base, raw, DAY, DAY, F.lit("2026-05-18 04:00:00"), ["issues"])
    assert rows(landing.read_raw(spark, f"{raw}/issues"), "landed_on") == [(late,), (late,)]


def test_a_reset_removes_days_that_are_gone(spark, tmp_path):
    base, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    for n, at in enumerate(("2026-05-17T06:00:00", "2026-05-18T06:00:00")):
        landing.write(envelopes(spark, [n], at=at), base, "issues")
    jobs.load_days(spark, base, raw, None, None, F.lit("2026-05-18 02:00:00"), ["issues"])
    landing.replace_day(envelopes(spark, []), base, "issues", DAY)
    jobs.load_days(spark, base, raw, None, None, F.lit("2026-05-18 03:00:00"), ["issues"])
    assert rows(landing.read_raw(spark, f"{raw}/issues"), "landed_on") == [(dt.date(2026, 5, 18),)]


def load(spark, base, raw, start=None, end=None):
    return jobs.load_days(spark, base, raw, start, end, F.lit("2026-05-18 02:00:00"), ["issues"])


def test_a_reader_planned_before_a_reload_finishes(spark, tmp_path):
    base, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    for n, at in enumerate(("2026-05-17T06:00:00", "2026-05-18T06:00:00")):
        landing.write(envelopes(spark, [n], at=at), base, "issues")
    load(spark, base, raw)
    before = landing.read_raw(spark, f"{raw}/issues")
    landing.write(envelopes(spark, [7, 8, 9]), base, "issues")
    load(spark, base, raw, DAY, DAY)
    title = F.variant_get("payload", "$.title", "string")
    assert rows(before, title) == [("t0",), ("t1",)]
    assert rows(landing.read_raw(spark, f"{raw}/issues"), title) == [("t1",), ("t7",), ("t8",), ("t9",)]


def test_a_load_that_died_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "raw")
    table = SlicedTable(spark, path)
    day = lambda n: spark.createDataFrame([(n, DAY)], "n INT, landed_on DATE")
    table.commit(table.write(day(1)))
    lost = table.write(day(2))
    assert rows(table.read(), "n") == [(1,)] and rows(table.read_load(lost), "n") == [(2,)]
    table.commit(table.write(day(3)))
    assert rows(SlicedTable(spark, path).read(), "n", "landed_on") == [(3, DAY)]


def test_a_table_of_days_reads_the_folders_it_needs(spark, tmp_path):
    table = SlicedTable(spark, str(tmp_path))
    late = DAY + dt.timedelta(days=1)
    frame = spark.createDataFrame([(1, DAY), (2, late)], "n INT, landed_on DATE")
    table.commit(table.write(frame, run=F.concat(F.lit("run-"), "n")))
    assert {day: set(found.runs) for day, found in table.state().items()} == {DAY: {"run-1"}, late: {"run-2"}}
    assert len(table.read(only=[late]).inputFiles()) == 1
    plan = table.read().filter(F.col("landed_on") == F.lit(late))._jdf.queryExecution().executedPlan().toString()
    assert "landed_on" in plan.split("PartitionFilters:")[1].split("]")[0]
    emptied = table.write(frame.filter("n > 5"))
    emptied.replaced = {"rows": {late}}
    table.commit(emptied)
    assert rows(table.read(), "n") == [(1,)]
    gone = table.write(frame.filter("n > 5"))
    gone.replaced = {"rows": {DAY}}
    table.commit(gone)
    assert table.read().count() == 0 and table.read().columns == ["n", "landed_on"]


def test_nothing_landed_loads_nothing(spark, tmp_path):
    base, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    landing.write(envelopes(spark, [1]), base, "issues")
    landing.replace_day(envelopes(spark, []), base, "issues", DAY)
    assert load(spark, base, raw) == {"issues": 0}
    load(spark, base, raw, DAY, DAY)


def test_partitions_tell_what_is_loaded(spark, tmp_path):
    base, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    landing.write(envelopes(spark, [1, 2]), base, "issues")
    load(spark, base, raw)
    status = jobs.partition_status(spark, f"{raw}/issues", DAY + dt.timedelta(days=1))
    assert rows(status, "date", "runs", "records") == [(DAY, ["run-1"], 2), (DAY + dt.timedelta(days=1), [], 0)]
