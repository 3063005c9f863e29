"""The landing zone: JSON lines in ``<base>/<resource>/year=/month=/day=`` folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CORRUPT_COLUMN, ENVELOPE, ENVELOPE_PARTS, LOADED_AT, PARTITIONS, RAW_ID, RESOURCES
from .sliced import ROWS, SlicedTable

LINE, QUARANTINE = "line", "quarantine"

# Text form of instants in landed records.
INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def check_resource(resource: str) -> str:
    if resource not in RESOURCES:
        raise ValueError(f"Unsupported resource {resource!r}; choose one of {', '.join(RESOURCES)}")
    return resource


def envelopes(items: DataFrame, resource: str, run_id: str, extracted_at: dt.datetime) -> DataFrame:
    """Wrap the fetched records of one run."""
    moment = F.lit(extracted_at.astimezone(dt.timezone.utc).isoformat(" ")).cast("timestamp")
    return items.select(
        F.lit(check_resource(resource)).alias("_resource"),
        F.lit(run_id).alias("_run_id"),
        moment.alias("_extracted_at"),
        F.struct("*").alias("payload"),
    )


def _body(records: DataFrame, resource: str) -> DataFrame:
    return records.filter(F.col("_resource") == check_resource(resource))


def day_folder(base: str, resource: str, day: dt.date) -> str:
    return f"{base}/{check_resource(resource)}/year={day:%Y}/month={day:%m}/day={day:%d}"


def replace_day(records: DataFrame, base: str, resource: str, day: dt.date) -> None:
    """Land one day's envelopes in place of what that day held, also when there are none."""
    (
        _body(records, resource)
        .select(*ENVELOPE_PARTS)
        .hint("rebalance")
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", INSTANT)
        .json(day_folder(base, resource, day))
    )


def write(
    records: DataFrame, base: str, resource: str, landed_on: Column | None = None, run_scoped: bool = False
) -> None:
    """Land envelopes under their date.

    By default the folder of each date present is replaced, so a repeated day
    leaves the same state and other days alone.  ``run_scoped`` keeps every run
    in a folder of its own instead.  The rebalance step gives each folder a few
    files of even size and splits a day that holds most of the rows.
    """
    day = F.to_date("_extracted_at") if landed_on is None else landed_on
    folders = list(PARTITIONS)
    columns = [F.date_format(day, pattern).alias(name) for name, pattern in zip(PARTITIONS, ("yyyy", "MM", "dd"))]
    if run_scoped:
        folders.append("run_id")
        columns.append(F.col("_run_id").alias("run_id"))
    body = _body(records, resource).select(*ENVELOPE_PARTS, *columns)
    (
        body.hint("rebalance", *folders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", INSTANT)
        .partitionBy(*folders)
        .json(f"{base}/{resource}")
    )


def _days(start: dt.date | None, end: dt.date | None) -> Column:
    """Range of days as a condition on the folder columns alone, so folders are pruned."""
    day = F.make_date(*[F.col(p).cast("int") for p in PARTITIONS])
    condition = F.lit(True)
    if start is not None:
        condition = condition & (day >= F.lit(start))
    if end is not None:
        condition = condition & (day <= F.lit(end))
    return condition


def read(
    spark: SparkSession, base: str, resource: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Landed envelopes of a resource, optionally of a range of days.

    A line that is not a record keeps its text in the corrupt column.
    """
    # The folder columns are named, since there may be no file in any folder.
    folders = ", ".join(f"{name} INT" for name in PARTITIONS)
    schema = f"{ENVELOPE}, {CORRUPT_COLUMN} STRING, {folders}"
    lines = spark.read.schema(schema).json(f"{base}/{check_resource(resource)}")
    return lines.filter(_days(start, end)) if start or end else lines


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """Every file below a prefix, whatever its folder layout; the day is taken from the file's path."""
    reader = spark.read.schema(f"{ENVELOPE}, {CORRUPT_COLUMN} STRING").option("recursiveFileLookup", "true")
    folder = F.col("_metadata.file_path")
    found = [F.regexp_extract(folder, f"/{p}=(\\d+)/", 1).try_cast("int").alias(p) for p in PARTITIONS]
    return reader.json(path).select("*", *found)


def is_broken() -> Column:
    """True for a line that is not JSON, or lacks a part of the envelope.

    It looks at every part, so all of them are parsed whatever a query selects.
    """
    broken = F.col(CORRUPT_COLUMN).isNotNull()
    for part in ENVELOPE_PARTS:
        broken = broken | F.col(part).isNull()
    return broken


def split_corrupt(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records, and the lines that are none."""
    return records.filter(~is_broken()).drop(CORRUPT_COLUMN), records.filter(is_broken())


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One column of payloads from JSON lines that may or may not be wrapped in an envelope."""
    whole = F.try_parse_json("value")
    inner = F.try_variant_get(whole, "$.payload", "variant")
    return (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(F.coalesce(inner, whole).alias("payload"))
    )


def manifest(landed: DataFrame) -> DataFrame:
    """Record count and extraction times per resource, run and landed day."""
    return landed.groupBy(
        F.col("_resource").alias("resource"),
        F.col("_run_id").alias("run_id"),
        F.make_date(*[F.col(p).cast("int") for p in PARTITIONS]).alias("date"),
    ).agg(
        F.count("*").alias("records"),
        F.min("_extracted_at").alias("started_at_utc"),
        F.max("_extracted_at").alias("finished_at_utc"),
    )


def day_manifest(landed: DataFrame, resource: str, run_id: str, day: dt.date, extracted_at: dt.datetime) -> DataFrame:
    """One row about a landed day, also if nothing was fetched that day."""
    asked = F.lit(extracted_at.astimezone(dt.timezone.utc).isoformat(" ")).cast("timestamp")
    file = F.regexp_extract("_metadata.file_path", "[^/]+$", 0)
    return landed.agg(
        F.count("*").alias("records"),
        F.coalesce(F.min("_extracted_at"), asked).alias("started_at_utc"),
        F.coalesce(F.max("_extracted_at"), asked).alias("finished_at_utc"),
        F.sort_array(F.collect_set(file)).alias("files"),
    ).select(
        F.lit(resource).alias("resource"),
        F.lit(run_id).alias("run_id"),
        F.lit(day).alias("date"),
        "records",
        "started_at_utc",
        "finished_at_utc",
        "files",
        F.current_timestamp().alias("generated_at_utc"),
    )


def run_summary(manifest: DataFrame) -> DataFrame:
    """One row per run over the rows of its resources."""
    return manifest.groupBy("run_id").agg(
        F.sort_array(F.collect_set("resource")).alias("resources"),
        F.sum("records").alias("records"),
        F.min("started_at_utc").alias("started_at_utc"),
        F.max("finished_at_utc").alias("finished_at_utc"),
    )


def _identity() -> Column:
    return F.md5(F.concat_ws("|", "_resource", "_run_id", F.to_json("payload")))


def to_raw(records: DataFrame, loaded_at: Column) -> DataFrame:
    """Add the loader's columns.  The id is a hash of the record, so a reload repeats it."""
    readable = split_corrupt(records)[0] if CORRUPT_COLUMN in records.columns else records
    return readable.withColumn(RAW_ID, _identity()).withColumn(LOADED_AT, loaded_at.cast("timestamp"))


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("landed_on", F.make_date(*[F.col(p).cast("int") for p in PARTITIONS])).drop(*PARTITIONS)


def load(landed: DataFrame, path: str, loaded_at: Column, start: dt.date | None, end: dt.date | None) -> int:
    """Replace the days from ``start`` to ``end`` of a raw table by what is landed; return the broken lines.

    The lines are parsed once: records and the lines that are none go to two
    parts of one load, whose tasks also tell its days, runs and broken lines.
    Days of the range that nothing is landed for any more become empty.
    """
    table, broken = SlicedTable(landed.sparkSession, path), is_broken()
    rows = _dated(landed).select(
        *ENVELOPE_PARTS,
        F.when(~broken, _identity()).alias(RAW_ID),
        loaded_at.cast("timestamp").alias(LOADED_AT),
        F.col(CORRUPT_COLUMN).alias(LINE),
        "landed_on",
        F.when(broken, QUARANTINE).otherwise(ROWS).alias("part"),
    )
    written = table.write(
        rows, F.col("part"), F.col("_run_id"), [F.count_if(F.col("part") == QUARANTINE).alias("broken")]
    )
    inside = lambda day: (start is None or day >= start) and (end is None or day <= end)
    written.replaced = {part: set(filter(inside, table.state(part))) for part in (ROWS, QUARANTINE)}
    table.commit(written)
    return written.metrics.get("broken") or 0


def write_raw(raw: DataFrame, path: str) -> None:
    """Raw table, with a shredded VARIANT payload; the days present are replaced."""
    table = SlicedTable(raw.sparkSession, path)
    table.commit(table.write(_dated(raw), run=F.col("_run_id")))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Records of all days as they are now; days that are loaded again later do not disturb the reader."""
    return SlicedTable(spark, path).read().drop(LINE)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are no records: their text if they are not JSON, else the parts they have."""
    return SlicedTable(spark, path).read(QUARANTINE).select(*ENVELOPE_PARTS, LINE, "landed_on")
