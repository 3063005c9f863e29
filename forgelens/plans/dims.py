"""Developer and date dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import surrogate_key

# First and last day of the date dimension.
FIRST_DAY = dt.date(2020, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)


def dim_developers(repositories: DataFrame, pull_requests: DataFrame, issues: DataFrame) -> DataFrame:
    """Everyone who owns a repository or wrote a pull request or issue.

    The duplicates go in one aggregate over the union, so most of them are
    already gone before the exchange.
    """
    people = repositories.select(
        F.col("owner_id").alias("developer_id"),
        F.col("owner_login").alias("developer_login"),
        F.col("owner_type").alias("developer_type"),
    )
    for written in (pull_requests, issues):
        people = people.unionByName(
            written.select(
                F.col("author_id").alias("developer_id"),
                F.col("author_login").alias("developer_login"),
                F.lit("User").alias("developer_type"),
            )
        )
    # Unknown ids are told by a count: a filter on the id would be pushed to the scan, and a task
    # that deals the rows of a file would have to parse each of its payloads for it.
    return (
        people.groupBy(*people.columns)
        .agg(F.count("developer_id").alias("__known"))
        .filter(F.col("__known") > 0)
        .select(surrogate_key("developer_id").alias("developer_key"), *people.columns)
    )


def dim_date(spark: SparkSession) -> DataFrame:
    """One row per day of the fixed calendar; weeks start on Monday and have ISO numbers."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(FIRST_DAY), F.lit(LAST_DAY), F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )
    day = F.col("date_day")
    return days.select(
        day.alias("date_id"),
        day,
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.monthname(day).alias("month_name"),
        F.weekofyear(day).cast("bigint").alias("week_of_year"),
        F.dayofyear(day).cast("bigint").alias("day_of_year"),
        (F.dayofweek(day) - 1).cast("bigint").alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        *[F.trunc(day, unit).alias(f"{unit}_start_date") for unit in ("week", "month", "quarter", "year")],
        (~F.dayofweek(day).isin(1, 7)).alias("is_weekday"),
    )
