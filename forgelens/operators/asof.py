"""Look up, for every row, the version of its key that was valid at the row's time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FOREVER = "9999-12-31 00:00:00"


def asof_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str,
    valid_to: str,
    bucket: str = "day",
) -> DataFrame:
    """Left join on ``key`` and ``valid_from <= at < valid_to`` (open end if NULL).

    A join on the key alone would meet every row of a key with every version of
    it.  Here rows and versions meet per (key, time bucket): a row's candidates
    are the versions that start in its bucket plus the one carried in from
    earlier buckets.  The carry is worked out on one row per (key, bucket), so
    a key that holds a third of all rows costs its number of buckets there; the
    final join has a handful of candidates per (key, bucket), and AQE may split
    its row side.  Versions of one key must not overlap.
    """
    details = [c for c in versions.columns if c not in (key, valid_from, valid_to)]
    starting = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("__key"),
        F.date_trunc(bucket, F.col(valid_from)).alias("__bucket"),
        F.struct(valid_from, valid_to, *details).alias("__version"),
    )
    probe = rows.withColumn("__slot", F.date_trunc(bucket, F.col(at)))

    # One row per (key, bucket): its newest version, and whether a row asks.
    # A version of zero length is never valid, so among equal starts the one
    # that lasts longest is the newest.
    lasting = F.struct(
        f"__version.{valid_from}",
        F.coalesce(F.col(f"__version.{valid_to}"), F.lit(_FOREVER).cast("timestamp")),
    )
    asked = probe.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"),
        F.col("__slot").alias("__bucket"),
        F.lit(None).cast(starting.schema["__version"].dataType).alias("__version"),
    )
    slots = (
        starting.withColumn("__asked", F.lit(False))
        .unionByName(asked.distinct().withColumn("__asked", F.lit(True)))
        .groupBy("__key", "__bucket")
        .agg(
            F.max_by("__version", F.when(~F.col("__asked"), lasting)).alias("__newest"),
            F.max("__asked").alias("__asked"),
        )
    )
    earlier = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        slots.withColumn("__version", F.last("__newest", ignorenulls=True).over(earlier))
        .filter(F.col("__asked") & F.col("__version").isNotNull())
        .select("__key", "__bucket", "__version")
    )
    begins, ends = F.col(f"__version.{valid_from}"), F.col(f"__version.{valid_to}")
    found = probe.join(
        starting.unionByName(carried),
        (F.col(key) == F.col("__key"))
        & (F.col("__slot") == F.col("__bucket"))
        & (begins <= F.col(at))
        & (ends.isNull() | (F.col(at) < ends)),
        "left",
    )
    return found.select(*rows.columns, begins.alias(valid_from), ends.alias(valid_to), *[f"__version.{c}" for c in details])
