"""Folders of Parquet that become visible at once.

Each write goes to a folder of its own and counts only once its tag is in the
commit log.  A job that dies half-way leaves the previous state in force, and a
repeated job overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ENTRY = "tag STRING, notes ARRAY<INT>"


class CommitLog:
    """Tags of finished writes, with notes.  Tags are compared as text, so they sort by time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._path = path

    def _entries(self) -> DataFrame | None:
        try:
            return self._spark.read.schema(ENTRY).json(self._path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def last(self, before: str | None = None) -> str | None:
        """The highest tag, or the highest one below ``before``."""
        tags = self._entries()
        if tags is None:
            return None
        if before is not None:
            tags = tags.filter(F.col("tag") < before)
        return tags.agg(F.max("tag")).first()[0]

    def between(self, after: str = "", before: str | None = None) -> dict[str, list[int]]:
        """Tags above ``after`` and below ``before``, with their notes."""
        tags = self._entries()
        if tags is None:
            return {}
        wanted = tags.filter(F.col("tag") > after)
        if before is not None:
            wanted = wanted.filter(F.col("tag") < before)
        return {row["tag"]: row["notes"] or [] for row in wanted.orderBy("tag").collect()}

    def add(self, tag: str, notes: Sequence[int] = ()) -> None:
        entry = self._spark.createDataFrame([(tag, list(notes))], ENTRY)
        entry.coalesce(1).write.mode("append").json(self._path)


def write_folder(df: DataFrame, path: str, *partitions: str, add: bool = False) -> None:
    """Replace the whole folder, also the partitions that ``df`` has no rows for, or ``add`` to it."""
    writer = df.write.mode("append" if add else "overwrite").option("partitionOverwriteMode", "static")
    writer = writer.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
