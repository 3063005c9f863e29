"""Stored relations: replaced or advanced as a whole, but never under a reader."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scd2
from ..sources.commits import CommitLog, write_folder
from ..sources.sliced import ROWS, Load, Slice, SlicedTable
from . import snapshot
from .facts import FACTS
from .staging import stage


class VersionedTable:
    """A table rebuilt in full by every build."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._path = path
        self._log = CommitLog(spark, f"{path}/commits")

    def write(self, df: DataFrame, tag: str, *more: DataFrame) -> DataFrame:
        """Write a build without showing it to readers yet; return what was written.

        A build may come in parts, which are written one after another.
        """
        path = f"{self._path}/build={tag}"
        write_folder(df, path)
        for part in more:
            write_folder(part, path, add=True)
        return self._spark.read.parquet(path)

    def commit(self, tag: str) -> None:
        self._log.add(tag)

    def replace(self, df: DataFrame, tag: str) -> DataFrame:
        written = self.write(df, tag)
        self.commit(tag)
        return written

    def read(self) -> DataFrame:
        tag = self._log.last()
        if tag is None:
            raise FileNotFoundError(f"no finished build in {self._path}")
        return self._spark.read.parquet(f"{self._path}/build={tag}")


class DailyFacts:
    """A fact table by landed day, of which a build writes the days that were loaded since the last one.

    Each day remembers the raw load it was made from.  A fact row belongs to the
    day whose raw row is the latest of its record and run; days that share a run,
    now or when they were built last, are therefore built together.
    """

    DAY = "run_day"

    def __init__(self, spark: SparkSession, path: str, resource: str) -> None:
        self._table = SlicedTable(spark, path, self.DAY)
        self._resource = resource

    def _facts(self, raw: DataFrame, day: str) -> DataFrame:
        _, make = FACTS[self._resource]
        return make(stage(raw, self._resource, keep=[day]), keep=[day]).withColumnRenamed(day, self.DAY)

    def pending(self, raw: Mapping[dt.date, Slice]) -> list[dt.date]:
        """Days to build again, given what the raw table holds."""
        built = self._table.state()
        source = {day: entry.source for day, entry in built.items()}
        now = {day: entry.load for day, entry in raw.items()}
        days = {day for day in {*source, *now} if source.get(day) != now.get(day)}
        runs_of = {day: built[day].runs if day in built else frozenset() for day in now | source}
        for day, entry in raw.items():
            runs_of[day] |= entry.runs
        while True:
            runs = frozenset().union(*(runs_of[day] for day in days))
            more = {day for day, own in runs_of.items() if own & runs} - days
            if not more:
                return sorted(days)
            days |= more

    def write(self, raw: SlicedTable, observed: Sequence[Column] = ()) -> Load | None:
        """Build the pending days without showing them; None if there are none."""
        state = raw.state()
        days = self.pending(state)
        if not days:
            return None
        rows = self._facts(raw.read(only=days, state=state), raw.column)
        written = self._table.write(rows, run=F.col("run_id"), observed=observed)
        written.replaced = {ROWS: set(days)}
        written.sources = {day: state[day].load for day in days if day in state}
        return written

    def commit(self, written: Load | None) -> None:
        if written is not None:
            self._table.commit(written)

    def read_load(self, written: Load) -> DataFrame:
        return self._table.read_load(written)

    def read(self, days: Iterable[dt.date] | None = None) -> DataFrame:
        return self._table.read(only=days)


class RepoHistory:
    """The version table of repositories, kept run by run.

    A run writes the open versions and the versions it closed.  Reading takes
    the open versions of the last run and the closed versions of all runs; the
    next run reads the open ones only.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._path = path
        self._log = CommitLog(spark, f"{path}/commits")

    def _run(self, tag: str) -> str:
        return f"{self._path}/versions/run={tag}"

    def apply(self, staged: DataFrame, tag: str, run_ts: Column, hard_deletes: str = "close") -> None:
        """Take in one run and show it to readers."""
        self.write(staged, tag, run_ts, hard_deletes)
        self.commit(tag)

    def write(self, staged: DataFrame, tag: str, run_ts: Column, hard_deletes: str = "close") -> DataFrame:
        """Write one run without showing it yet; return the history as it would be.

        ``staged`` holds all rows so far, or a listing that is complete by itself:
        what it lacks is closed.  Repeating the last run changes nothing; older
        ones are refused.
        """
        last = self._log.last()
        if last is not None and tag < last:
            raise ValueError(f"run {tag} comes before the last one taken in, {last}; rebuild instead")
        previous = self._log.last(before=tag) if tag == last else last
        open_versions = None
        if previous is not None:
            open_versions = self._spark.read.parquet(self._run(previous)).filter(F.col(scd2.STATE) == "open")
        versions = snapshot.advance_repos(open_versions, staged, run_ts, hard_deletes)
        write_folder(versions, self._run(tag), scd2.STATE)
        return self._versions(tag)

    def commit(self, tag: str) -> None:
        if tag != self._log.last():
            self._log.add(tag)

    def read(self) -> DataFrame:
        last = self._log.last()
        if last is None:
            raise FileNotFoundError(f"no finished run in {self._path}")
        return self._versions(last)

    def _versions(self, last: str) -> DataFrame:
        # The folder names are partition columns, so only the folders needed are
        # read.  Runs are text: read as numbers, tags would lose leading zeros.
        held = self._spark.read.parquet(self._run(last)).drop(scd2.STATE).schema
        schema = held.add("run", "string").add(scd2.STATE, "string")
        every = self._spark.read.schema(schema).parquet(f"{self._path}/versions")
        run, state = F.col("run"), F.col(scd2.STATE)
        wanted = ((state == "closed") & (run <= last)) | ((state == "open") & (run == last))
        return every.filter(wanted).drop("run", scd2.STATE)
