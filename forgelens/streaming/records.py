"""The two processed records, their contract, and windowed totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import star_tier
from .messages import held

Record = dict[str, tuple[str, bool]]


def trending(parsed: DataFrame, event_time: Column | None = None) -> DataFrame:
    """One classified record per repository message, stamped with the processing time."""
    moment = F.current_timestamp() if event_time is None else event_time
    return parsed.select(
        "repo_id",
        "full_name",
        "owner_login",
        "language",
        "stargazers_count",
        "forks_count",
        "open_issues_count",
        star_tier(F.col("stargazers_count")).alias("star_tier"),
        moment.alias("event_time"),
        "value",
        *held(parsed),
    )


def developer_activity(parsed: DataFrame) -> DataFrame:
    """One record per repository message with a known owner, stamped with the message time."""
    return parsed.filter(F.col("owner_login").isNotNull()).select(
        "owner_login",
        "owner_type",
        F.lit(1).cast("bigint").alias("repos_count"),
        F.col("stargazers_count").alias("total_stars"),
        F.col("forks_count").alias("total_forks"),
        F.col("language").alias("primary_language"),
        F.col("row_time").alias("event_time"),
        "value",
        *held(parsed),
    )


def is_complete(record: Record) -> Column:
    """Whether every required field is there."""
    required = [F.col(name).isNotNull() for name, (_, needed) in record.items() if needed]
    condition = required[0]
    for field in required[1:]:
        condition = condition & field
    return condition


def conform(rows: DataFrame, record: Record) -> DataFrame:
    """Exactly the record's fields, in its types, and the position of its message where that is known."""
    return rows.select(*held(rows), *[F.col(name).cast(kind).alias(name) for name, (kind, _) in record.items()])


def missing_fields(record: Record) -> Column:
    """Names of the required fields a row lacks."""
    names = [F.when(F.col(name).isNull(), F.lit(name)) for name, (_, needed) in record.items() if needed]
    return F.array_compact(F.array(*names))


def as_served(rows: DataFrame, record: Record) -> DataFrame:
    """Rows as the serving tables hold them: no NULL text, times in whole seconds."""
    columns = []
    for name, (kind, _) in record.items():
        column = F.col(name)
        if kind == "string":
            column = F.coalesce(column, F.lit(""))
        elif kind == "timestamp":
            column = F.date_trunc("second", column)
        columns.append(column.alias(name))
    return rows.select(*columns)


def owner_totals(trending_rows: DataFrame) -> DataFrame:
    """True totals per owner, from the last row of each of its repositories."""
    return (
        trending_rows.filter(F.col("owner_login").isNotNull())
        .groupBy("owner_login")
        .agg(
            F.count("*").alias("repos_count"),
            F.sum("stargazers_count").alias("total_stars"),
            F.sum("forks_count").alias("total_forks"),
        )
    )


def windowed_owner_totals(
    parsed: DataFrame, window: str = "1 day", late: str = "10 minutes", heartbeats: DataFrame | None = None
) -> DataFrame:
    """Totals per owner and tumbling window of message time.

    In update mode with a keyed sink a replay that ends with an idle source
    still delivers its last window.  Append mode writes a window once, when the
    watermark has passed it; ``heartbeats``, a stream of times (``row_time``),
    move the watermark on while no messages come, so that the last window closes.
    """
    rows = parsed.filter(F.col("owner_login").isNotNull()).select(
        "row_time", "repo_id", "owner_login", "stargazers_count", "forks_count", F.lit(1).alias("message")
    )
    if heartbeats is not None:
        none = {c: F.lit(None).cast(kind) for c, kind in rows.dtypes if c != "row_time"}
        rows = rows.unionByName(heartbeats.select(F.col("row_time").cast("timestamp")).withColumns(none))
    return (
        rows.withWatermark("row_time", late)
        .groupBy(F.window("row_time", window).alias("w"), "owner_login")
        .agg(
            F.count("message").alias("repos_count"),
            F.sum("stargazers_count").alias("total_stars"),
            F.sum("forks_count").alias("total_forks"),
        )
        # A condition on the owner would be moved below the watermark, which heartbeats have to reach.
        .filter(F.col("repos_count") > 0)
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "owner_login",
            "repos_count",
            "total_stars",
            "total_forks",
        )
    )
