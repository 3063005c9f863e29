"""Daily jobs: land a day, load it, backfill a range of days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import first_by
from ..schemas import RESOURCES
from ..sources import landing
from ..sources.sliced import SlicedTable

# First daily partition.
FIRST_PARTITION = dt.date(2026, 5, 17)


def daily_partitions(today: dt.date, first: dt.date = FIRST_PARTITION) -> list[dt.date]:
    """Every day from the first one to ``today``, which is included."""
    return [first + dt.timedelta(days=n) for n in range((today - first).days + 1)]


def land_day(
    items: Mapping[str, DataFrame],
    day: dt.date,
    base: str,
    run_id: str,
    extracted_at: dt.datetime,
    resources: Sequence[str] = RESOURCES,
    page_order: Sequence[str] = ("page", "position"),
) -> DataFrame:
    """Land the fetched items of one day; write and return its manifest.

    Result pages may repeat an id; the first occurrence in page order stays, or
    the first by its text where the order is not known.  Landing the same day
    again replaces it, also by nothing.  The manifest counts what arrived in the
    landing zone, so the items are fetched and deduplicated once.
    """
    manifests = []
    for resource in resources:
        landing.check_resource(resource)
        fetched = items[resource]
        order = [c for c in page_order if c in fetched.columns]
        text = F.to_json(F.struct(*[c for c in fetched.columns if c not in order]))
        fetched = first_by(fetched.withColumn("__text", text), ["id"], [*order, "__text"]).drop(*order, "__text")
        landing.replace_day(landing.envelopes(fetched, resource, run_id, extracted_at), base, resource, day)
        spark = fetched.sparkSession
        path = f"{base}/manifests/{resource}/date={day.isoformat()}"
        landed = landing.read(spark, base, resource, day, day)
        found = landing.day_manifest(landed, resource, run_id, day, extracted_at).drop("date")
        found.write.mode("overwrite").option("timestampFormat", landing.INSTANT).json(path)
        manifests.append(spark.read.schema(found.schema).json(path).withColumn("date", F.lit(day)))
    return reduce(DataFrame.unionByName, manifests)


def load_days(
    spark: SparkSession,
    base: str,
    raw_path: str,
    start: dt.date | None,
    end: dt.date | None,
    loaded_at: Column,
    resources: Sequence[str] = RESOURCES,
) -> dict[str, int]:
    """Load a range of landed days into the raw tables, one job per resource.

    Serves the daily load (one day), a backfill (a range) and a reset (no
    bounds): each raw day in the range is replaced by what is landed, and is
    emptied if nothing is landed any more.  Lines that are no records are set
    aside in the same pass.  Returns their number per resource.
    """
    return {
        resource: landing.load(
            landing.read(spark, base, resource, start, end), f"{raw_path}/{resource}", loaded_at, start, end
        )
        for resource in resources
    }


def raw_tables(spark: SparkSession, raw_path: str, resources: Sequence[str] = RESOURCES) -> dict[str, DataFrame]:
    return {r: landing.read_raw(spark, f"{raw_path}/{r}") for r in resources}


def partition_status(spark: SparkSession, raw_path: str, today: dt.date, first: dt.date = FIRST_PARTITION) -> DataFrame:
    """One row per daily partition: the runs and the number of records loaded for it, if any."""
    table = SlicedTable(spark, raw_path)
    state = table.state()
    days = [(day, sorted(state[day].runs) if day in state else []) for day in daily_partitions(today, first)]
    loaded = table.read(state=state).groupBy(F.col(table.column).alias("date")).agg(F.count("*").alias("records"))
    partitions = spark.createDataFrame(days, "date DATE, runs ARRAY<STRING>")
    return partitions.join(loaded, "date", "left").fillna(0, ["records"])
