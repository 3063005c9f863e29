"""Raw messages, ``(key BINARY, value BINARY, timestamp TIMESTAMP)``, and what is in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.feeds import TIMESTAMP_TEXT

# The paths the stream reads, all as text so that one parse serves every cast.
MESSAGE = """
  payload STRUCT<
    id: STRING, full_name: STRING, language: STRING,
    stargazers_count: STRING, forks_count: STRING, open_issues_count: STRING,
    owner: STRUCT<login: STRING, type: STRING>>
"""
# Where a message stands in its source: decides between messages of one time.
POSITION = "position"
COUNTS = ("stargazers_count", "forks_count", "open_issues_count")


def held(rows: DataFrame) -> list[str]:
    """The position, if the rows have one."""
    return [c for c in rows.columns if c == POSITION]


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Every line of every file below ``path`` as a message, stamped with the file's time.

    ``position`` says where a line comes from, as far as a scan knows it: a sink
    adds the place among the lines of one read.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.struct("_metadata.file_path", "_metadata.file_block_start").alias(POSITION),
    )


def kafka_options(servers: str, topic: str, max_records: int | None = None) -> dict[str, str]:
    """Options of the Kafka source: from the beginning, with a bound per batch only if one is named."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    return options | ({"maxOffsetsPerTrigger": str(max_records)} if max_records else {})


def kafka_messages(spark: SparkSession, servers: str, topic: str, max_records: int | None = None) -> DataFrame:
    """Messages of a topic.  Needs Spark's Kafka package on the class path."""
    source = spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_records)).load()
    return source.select("key", "value", "timestamp", F.struct("partition", "offset").alias(POSITION))


def envelope_messages(envelopes: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Envelopes as the messages a connector would publish for their lines."""
    options = {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_TEXT}
    record = F.to_json(F.struct("_resource", "_run_id", "_extracted_at", "payload"), options)
    return envelopes.select(
        F.lit(None).cast("binary").alias("key"),
        record.cast("binary").alias("value"),
        (F.col("_extracted_at") if timestamp is None else timestamp).alias("timestamp"),
        *held(envelopes),
    )


def parse_repositories(messages: DataFrame) -> DataFrame:
    """Typed repository columns and the message time.

    A missing count is 0; a count that is no number is NULL, which the record
    contract sends to the dead letters.
    """
    payload = F.from_json(F.col("value").cast("string"), MESSAGE)["payload"]
    moment = F.col("timestamp").cast("timestamp").alias("row_time")
    parsed = messages.select("key", "value", moment, payload.alias("p"), *held(messages))
    counts = [F.coalesce(F.col(f"p.{c}"), F.lit("0")).try_cast("bigint").alias(c) for c in COUNTS]
    return parsed.select(
        "key",
        "value",
        "row_time",
        F.col("p.id").try_cast("bigint").alias("repo_id"),
        "p.full_name",
        F.col("p.owner.login").alias("owner_login"),
        F.col("p.owner.type").alias("owner_type"),
        "p.language",
        *counts,
        *held(messages),
    )


def drop_redelivered(messages: DataFrame, within: str = "7 days") -> DataFrame:
    """Messages delivered again within the topic's retention, seen by content and time.

    The state holds a 128-bit digest per message instead of its text.
    """
    return (
        messages.withColumn("__digest", F.md5("value"))
        .withWatermark("timestamp", within)
        .dropDuplicatesWithinWatermark(["__digest", "timestamp"])
        .drop("__digest")
    )
