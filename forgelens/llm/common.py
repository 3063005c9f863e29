"""What the operators share: tables, stored steps, words, exact numbering of rows."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import prepare, scratch_dir

# A word is a run of bytes other than the six ASCII blanks.
BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Columns of ``documents``, in order.
DOCUMENT = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def ready(spark: SparkSession) -> SparkSession:
    """The session's settings, and this package on the path of new Python workers.

    On a cluster the package is installed or handed over with ``--py-files``;
    the path serves workers on this machine.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents`` only; further columns are dropped."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in DOCUMENT.items()])


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Rows numbered from 0 in a total ``order`` without gathering them in one task.

    Rows are dealt into sorted ranges and stored; the number of a row is the
    count of rows in earlier ranges and its place in its own.
    """
    ranges = df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_range"))
    ranges = stored(ranges, label)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").agg(F.count("*").alias("_n")).select(
        F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.withColumn("_place", place)
        .join(starts, F.col("_range") == F.col("_of"))
        .withColumn(name, F.col("_start") + F.col("_place") - 1)
        .drop("_range", "_of", "_start", "_place")
    )


def sample_of(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """At most ``size`` rows of different ``keys``, chosen by their hash; fewer where there are not as many, or keys repeat.

    A threshold on the hash leaves about a quarter more rows than asked for of
    the whole table, and repeated keys meet before they move, so no task holds
    or sends more than that, however many tasks and rows there are.
    """
    count = rows.count()
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    share = min(1.0, (1.25 * size + 200) / max(1, count))
    some = rows.filter(place < int(share * (1 << 40)))
    others = [F.max(c).alias(c) for c in rows.columns if c not in keys]
    once = some.groupBy(*keys).agg(*others) if others else some.select(*keys).distinct()
    return once.orderBy(place, *keys).limit(size)
