"""Feeds of tables that come as one file with all rows in one piece."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forgelens import queries
from forgelens.plans import dims, staging
from forgelens.sources import feeds

PART = ["id AS p_partkey", "concat('red part ', id) AS p_name", "'PROMO' AS p_type", "'Brand#1' AS p_brand", "int(id % 50) AS p_size"]


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "DEALT_ROWS", dict.fromkeys(feeds.DEALT_ROWS, 50))
    # A third of the rows have one key, and some are there twice.
    rows = spark.range(400).selectExpr(*PART).withColumn("p_partkey", F.expr("if(p_partkey % 3 = 0, 9, p_partkey)"))
    rows.unionByName(rows.filter("p_partkey > 380")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def spread(rows):
    """Rows of each task that has some."""
    return [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]


def test_one_piece_is_dealt_over_tasks_and_keeps_its_rows(spark, tables):
    found = feeds.feed(spark, tables, "repositories")
    assert len(spread(found)) >= 8 and max(spread(found)) <= 3 * 2 * 50
    plain = feeds.repositories(feeds.table(spark, tables, "part"))
    assert len(spread(plain)) == 1
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


def test_a_batch_of_one_piece_is_dealt_over_tasks(spark, tables, tmp_path):
    seen = []
    rows = feeds.feed_stream(spark, tables, "repositories").select("_run_id", "position.row_index")
    query = rows.writeStream.foreachBatch(lambda batch, _: seen.extend(spread(batch)))
    query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    plain = feeds.repositories(feeds.table(spark, tables, "part"))
    assert len(seen) >= 8 and max(seen) <= 3 * 2 * 50 and sum(seen) == plain.count()


def test_dealt_streams_keep_the_latest_record(spark, tables, monkeypatch):
    dealt = {tuple(r) for r in queries.stream_developer_latest(spark, tables).collect()}
    monkeypatch.setitem(feeds.DEALT_ROWS, "repositories", 10_000)
    assert dealt == {tuple(r) for r in queries.stream_developer_latest(spark, tables).collect()}


def test_records_that_are_sorted_are_dealt_over_tasks(spark, tables):
    lines = spark.range(400).selectExpr(
        "id AS l_orderkey", "int(id % 7) AS l_linenumber", "id % 30 AS l_partkey", "id % 9 AS l_suppkey", "'N' AS l_returnflag",
        "'F' AS l_linestatus", "0.02D AS l_tax", "timestamp '1996-05-01 00:00:00' AS l_shipdate"
    )
    lines.unionByName(lines.filter("l_orderkey < 40")).coalesce(1).write.parquet(f"{tables}/lineitem.parquet")
    plain = feeds.feed(spark, tables, "pull_requests")
    found = feeds.feed(spark, tables, "pull_requests", sorts=True)
    assert len(spread(plain)) == 1 and len(spread(found)) >= 6 and max(spread(found)) <= 2 * 50
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    dealt = {tuple(r) for r in queries.fact_pull_requests(spark, tables).collect()}
    assert len(dealt) == 400


def test_unknown_developers_are_dropped_behind_the_deal(spark, tables):
    events = spark.range(400).selectExpr(
        "id AS event_id", "timestamp '2024-01-01 00:00:00' AS ts", "id % 30 AS user_id", "'view' AS event_type",
        "1.0D AS value", """if(id % 5 = 0, '{}', concat('{"k": ', id % 90, '}')) AS props"""
    )
    events.coalesce(1).write.parquet(f"{tables}/events.parquet")
    issues = staging.stage(feeds.payload_text(feeds.feed(spark, tables, "issues", sorts=True)), "issues")
    owners = spark.createDataFrame([], "owner_id BIGINT, owner_login STRING, owner_type STRING")
    found = dims.dim_developers(owners, issues, issues.filter("false"))
    # No task parses the payloads of all the rows that it deals.
    dealt, below = found._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert "from_json" in dealt and "from_json" not in below
    ids = {r[0] for r in issues.select("author_id").collect()}
    assert None in ids and ids - {None} == {r[0] for r in found.select("developer_id").collect()}
