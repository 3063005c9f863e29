from __future__ import annotations

import json

import pytest
from samples import envelope_lines, moment, rows, sample_payloads, write_lines
from pyspark.sql import functions as F

from forgelens.schemas import DEVELOPER_RECORD, TRENDING_RECORD
from forgelens.sources.replacing import ReplacingTable
from forgelens.streaming import avro, messages, records, sinks
from forgelens.streaming.totals import OwnerTotals


def batch_messages(spark, lines, at="2026-04-25T06:00:00"):
    frame = spark.createDataFrame([(line, moment(at)) for line in lines], "line STRING, timestamp TIMESTAMP")
    return frame.select(
        F.lit(None).cast("binary").alias("key"), F.col("line").cast("binary").alias("value"), "timestamp"
    )


def drain(stream, table, checkpoint, **options):
    if "record" in options:
        options.setdefault("dead_letters", f"{checkpoint}-letters")
    query = sinks.upsert(stream, table, str(checkpoint), **options)
    query.awaitTermination()
    return table


def trending_table(spark, path):
    return ReplacingTable(spark, str(path), "repo_id", ["event_time"])


def repo_line(key, stars=5, owner="alice", **more):
    payload = {"id": key, "full_name": f"{owner}/r{key}", "owner": {"login": owner, "type": "User"}, "stargazers_count": stars}
    return json.dumps({"_resource": "repositories", "payload": payload | more})


def test_parse_and_classify(spark):
    lines = envelope_lines("repositories", sample_payloads()["repositories"])
    parsed = messages.parse_repositories(batch_messages(spark, lines))
    trending = records.conform(records.trending(parsed), TRENDING_RECORD)
    assert rows(trending, "repo_id", "star_tier", "open_issues_count", "language") == [
        (100001, "medium", 5, "Python"), (100002, "medium", 5, "Python"), (100003, "low", 5, "Python")
    ]
    assert trending.select("event_time").first()[0] is not None
    developers = records.conform(records.developer_activity(parsed), DEVELOPER_RECORD)
    assert rows(developers, "owner_login", "owner_type", "repos_count", "total_stars") == [
        ("alice", "User", 1, 128), ("bob", "User", 1, 347), ("carol", "Organization", 1, 56)
    ]


def test_missing_counts_are_zero_and_bad_ones_unknown(spark):
    lines = [repo_line(1, None), repo_line(2, "12"), repo_line(3, "many"), "{broken", repo_line(5, 7, owner=None)]
    parsed = messages.parse_repositories(batch_messages(spark, lines))
    found = {r.repo_id: (r.stargazers_count, r.forks_count) for r in parsed.collect()}
    assert found == {1: (0, 0), 2: (12, 0), 3: (None, 0), None: (0, 0), 5: (7, 0)}
    assert records.developer_activity(parsed).count() == 3


def test_serving_form_has_no_nulls_and_whole_seconds(spark):
    parsed = messages.parse_repositories(batch_messages(spark, [repo_line(1)], "2026-04-25T06:00:00.750000"))
    served = records.as_served(records.trending(parsed, F.col("row_time")), TRENDING_RECORD).first()
    assert served.language == "" and served.event_time.microsecond == 0


def test_stream_equals_batch_restarts_and_takes_redelivery(spark, tmp_path):
    inbox, table = tmp_path / "in", trending_table(spark, tmp_path / "t")
    lines = envelope_lines("repositories", sample_payloads()["repositories"])
    write_lines(inbox / "year=2026" / "month=04", lines)
    letters = str(tmp_path / "letters")

    def run():
        parsed = messages.parse_repositories(messages.file_messages(spark, str(inbox), max_files=1))
        rows_ = records.trending(parsed, F.col("row_time"))
        return drain(rows_, table, tmp_path / "c", record=TRENDING_RECORD, dead_letters=letters)

    run()
    batch = records.trending(messages.parse_repositories(batch_messages(spark, lines)), F.col("row_time"))
    columns = [c for c in TRENDING_RECORD if c != "event_time"]
    assert rows(table.read().fillna(""), *columns) == rows(batch.fillna(""), *columns)

    # A restart without news changes nothing; new files go on where it stopped.
    run()
    assert table.read().count() == 3
    write_lines(inbox, [lines[0], repo_line(7, 5000), "{broken"], "later.jsonl")
    run()
    assert table.read().count() == 4
    assert rows(table.read().filter("repo_id = 7"), "star_tier") == [("high",)]
    assert [tuple(r.missing) for r in spark.read.parquet(letters).collect()] == [("repo_id", "full_name")]


def test_replacing_table_keeps_the_last_row(spark, tmp_path):
    table = ReplacingTable(spark, str(tmp_path / "t"), "k", ["at"])
    with pytest.raises(FileNotFoundError):
        table.read()

    def batch(*entries):
        return spark.createDataFrame([(k, v, moment(at)) for k, v, at in entries], "k BIGINT, v STRING, at TIMESTAMP")

    table.append(batch((1, "a", "2026-01-01T00:00:00"), (1, "b", "2026-01-02T00:00:00"), (2, "c", "2026-01-01T00:00:00")), 0)
    assert rows(table.read(), "k", "v") == [(1, "b"), (2, "c")]
    table.append(batch((2, "d", "2026-01-01T00:00:00"), (1, "late", "2026-01-01T12:00:00")), 1)
    expected = [(1, "b"), (2, "d")]
    assert rows(table.read(), "k", "v") == expected
    # The same batch again replaces itself, also after a merge.
    table.append(batch((2, "d", "2026-01-01T00:00:00"), (1, "late", "2026-01-01T12:00:00")), 1)
    assert rows(table.read(), "k", "v") == expected
    table.merge()
    assert rows(table.read(), "k", "v") == expected and table.read_all().count() == 2
    table.append(batch((3, "e", "2026-01-03T00:00:00")), 2)
    assert rows(table.read(), "k", "v") == [*expected, (3, "e")]
    table.merge()
    assert rows(table.read(), "k", "v") == [*expected, (3, "e")]
    assert rows(ReplacingTable(spark, str(tmp_path / "t"), "k", ["at"]).read(), "k") == [(1,), (2,), (3,)]


def test_batches_are_merged_on_the_way(spark, tmp_path):
    inbox, table = tmp_path / "in", trending_table(spark, tmp_path / "t")
    for n in range(5):
        write_lines(inbox, [repo_line(1, n), repo_line(10 + n)], f"{n}.jsonl")
    parsed = messages.parse_repositories(messages.file_messages(spark, str(inbox), max_files=1))
    drain(records.trending(parsed), table, tmp_path / "c", record=TRENDING_RECORD, merge_every=2)
    # Two merges took in four batches: their five keys, and the two rows of the last batch.
    assert table.read_all().count() == 7
    assert rows(table.read(), "repo_id") == [(1,), (10,), (11,), (12,), (13,), (14,)]


def test_totals_per_owner_collapse_or_add_up(spark, tmp_path):
    inbox = tmp_path / "in"
    write_lines(inbox, [repo_line(1, 10), repo_line(2, 20), repo_line(3, 5, owner="bob")])
    stream = messages.parse_repositories(messages.file_messages(spark, str(inbox)))
    latest = ReplacingTable(spark, str(tmp_path / "d"), "owner_login", ["event_time"])
    drain(records.developer_activity(stream), latest, tmp_path / "c1", record=DEVELOPER_RECORD)
    assert rows(latest.read(), "owner_login", "repos_count") == [("alice", 1), ("bob", 1)]

    repos = trending_table(spark, tmp_path / "t")
    drain(records.trending(stream), repos, tmp_path / "c2", record=TRENDING_RECORD)
    assert rows(records.owner_totals(repos.read()), "owner_login", "repos_count", "total_stars") == [
        ("alice", 2, 30), ("bob", 1, 5)
    ]


def test_windows_deliver_their_last_one(spark, tmp_path):
    inbox = str(tmp_path / "in")
    days = [(f"2026-04-2{n}T06:00:00", n) for n in range(1, 6)]
    frame = batch_messages(spark, [repo_line(1)], days[0][0])
    for at, n in days[1:]:
        frame = frame.unionByName(batch_messages(spark, [repo_line(n), repo_line(n + 10)], at))
    frame.coalesce(1).write.parquet(inbox)
    stream = spark.readStream.schema(frame.schema).parquet(inbox)
    table = ReplacingTable(spark, str(tmp_path / "w"), ["window_start", "owner_login"], ["repos_count"])
    totals = records.windowed_owner_totals(messages.parse_repositories(stream))
    drain(totals, table, tmp_path / "c", output_mode="update")
    assert rows(table.read(), F.dayofmonth("window_start"), "repos_count") == [(21, 1), (22, 2), (23, 2), (24, 2), (25, 2)]


def test_redelivered_messages_are_dropped(spark, tmp_path):
    inbox = str(tmp_path / "in")
    once = batch_messages(spark, [repo_line(1), repo_line(2)])
    once.unionByName(once).coalesce(1).write.parquet(inbox)
    stream = messages.drop_redelivered(spark.readStream.schema(once.schema).parquet(inbox))
    query = stream.writeStream.format("memory").queryName("once").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    assert spark.table("once").count() == 2


def test_kafka_options():
    options = messages.kafka_options("broker:9092", "repos.raw")
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options
    assert messages.kafka_options("broker:9092", "repos.raw", 500)["maxOffsetsPerTrigger"] == "500"
    assert options["subscribe"] == "repos.raw"


def test_avro_schema_and_frame(spark):
    schema = json.loads(avro.avro_schema("TrendingRepo", TRENDING_RECORD))
    kinds = {f["name"]: f["type"] for f in schema["fields"]}
    assert kinds["repo_id"] == "long" and kinds["language"] == ["null", "string"]
    assert kinds["event_time"] == {"type": "long", "logicalType": "timestamp-millis"}
    framed = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07body"),)], "value BINARY")
    assert bytes(framed.select(avro.unframed(F.col("value"))).first()[0]) == b"body"


def test_a_contract_without_a_folder_for_dead_letters_is_refused(spark, tmp_path):
    table = ReplacingTable(spark, str(tmp_path / "t"), "repo_id", ["event_time"])
    with pytest.raises(ValueError):
        sinks.upsert(spark.readStream.format("rate").load(), table, str(tmp_path / "c"), record=TRENDING_RECORD)


def test_the_winner_of_a_tie_does_not_depend_on_input_order(spark, tmp_path):
    pair = [(1, moment("2026-01-01T00:00:00"), "a"), (1, moment("2026-01-01T00:00:00"), "b")]
    winners = set()
    for name, some in (("one", pair), ("two", pair[::-1])):
        table = ReplacingTable(spark, str(tmp_path / name), "k", ["at"])
        table.append(spark.createDataFrame(some, "k BIGINT, at TIMESTAMP, v STRING").coalesce(1), 0)
        winners |= {r.v for r in table.read().collect()}
    assert winners == {"b"}


def test_of_equal_times_the_later_line_wins(spark, tmp_path):
    """The greatest content does not: the last line of the owner is the one with the fewest stars."""
    inbox = tmp_path / "in"
    lines = [repo_line(n, 100 - n, owner=f"o{n % 3}") for n in range(30)]
    write_lines(inbox, lines)
    stream = messages.parse_repositories(messages.file_messages(spark, str(inbox)))
    table = ReplacingTable(spark, str(tmp_path / "t"), "owner_login", ["event_time", messages.POSITION])
    drain(records.developer_activity(stream), table, tmp_path / "c", record=DEVELOPER_RECORD, dead_letters=str(tmp_path / "l"))
    assert rows(table.read(), "owner_login", "total_stars") == [("o0", 73), ("o1", 72), ("o2", 71)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_base_alone_is_read_without_a_shuffle_and_a_merge_rewrites_touched_buckets(spark, tmp_path):
    table = ReplacingTable(spark, str(tmp_path / "t"), "k", ["at"], buckets=4)
    frame = spark.range(100).selectExpr("id AS k", "id AS at", "'a' AS v")
    table.append(frame, 0)
    assert "Exchange" in plan_of(table.read())
    table.merge()
    assert "Exchange" not in plan_of(table.read()) and "Window" not in plan_of(table.read())
    before = {b: s.load for b, s in table._base.state().items()}
    assert len(before) == 4
    table.append(spark.createDataFrame([(5, 500, "b")], "k BIGINT, at BIGINT, v STRING"), 1)
    assert rows(table.read().filter("v = 'b'"), "k") == [(5,)] and table.read().count() == 100
    table.merge()
    after = {b: s.load for b, s in table._base.state().items()}
    assert sum(before[b] != after[b] for b in before) == 1
    assert rows(table.read().filter("v = 'b'"), "k") == [(5,)] and table.read().count() == 100
    table.merge()
    assert {b: s.load for b, s in table._base.state().items()} == after
    with pytest.raises(ValueError, match="4 buckets"):
        ReplacingTable(spark, str(tmp_path / "t"), "k", ["at"], buckets=8).read()


def test_owner_totals_follow_each_batch(spark, tmp_path):
    table = trending_table(spark, tmp_path / "t")
    totals = OwnerTotals(spark, str(tmp_path / "o"), table)

    def take(number, *found, merge=False):
        frame = spark.createDataFrame([(k, o, s, 1, moment(at)) for k, o, s, at in found],
                                      "repo_id BIGINT, owner_login STRING, stargazers_count BIGINT, forks_count BIGINT, event_time TIMESTAMP")
        for _ in range(2):  # delivered again before the stream noted it
            totals.change(frame, number)
            table.append(frame, number)
        if merge:
            table.merge()
            totals.merge()
            totals.change(frame, number)
        assert rows(totals.read(), "owner_login", "repos_count", "total_stars") == rows(
            records.owner_totals(table.read()), "owner_login", "repos_count", "total_stars"
        )

    take(0, (1, "a", 10, "2026-01-01T00:00:00"), (2, "a", 5, "2026-01-01T00:00:00"), (3, None, 5, "2026-01-01T00:00:00"))
    take(1, (1, "b", 11, "2026-01-02T00:00:00"), (4, "c", 1, "2026-01-02T00:00:00"), merge=True)
    take(2, (2, "b", 6, "2026-01-03T00:00:00"), (1, "a", 99, "2025-01-01T00:00:00"))
    assert rows(totals.read(), "owner_login", "repos_count", "total_stars") == [("b", 2, 17), ("c", 1, 1)]


def test_a_heartbeat_closes_the_last_window(spark, tmp_path):
    inbox, beats = str(tmp_path / "in"), str(tmp_path / "beats")
    frame = batch_messages(spark, [repo_line(1), repo_line(2)], "2026-04-21T06:00:00")
    frame.write.parquet(inbox)
    stream = spark.readStream.schema(frame.schema).parquet(inbox)

    def closed(name, heartbeats):
        table = ReplacingTable(spark, str(tmp_path / name), ["window_start", "owner_login"], ["repos_count"])
        totals = records.windowed_owner_totals(messages.parse_repositories(stream), heartbeats=heartbeats)
        return drain(totals, table, tmp_path / f"c-{name}").read()

    spark.createDataFrame([(moment("2026-04-23T00:00:00"),)], "row_time TIMESTAMP").write.parquet(beats)
    heartbeats = spark.readStream.schema("row_time TIMESTAMP").parquet(beats)
    assert closed("silent", None).count() == 0
    assert rows(closed("beating", heartbeats), "owner_login", "repos_count") == [("alice", 2)]


def test_state_is_kept_by_rocksdb(spark):
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled") == "true"
