"""Tables by day or bucket, each of them in the folder of the load that wrote it last.

A load writes its rows below a folder of its own and then adds one row per slice
(a day, or a bucket) to the commit log.  A slice's latest row names the folder
that holds it, so a slice is replaced, or emptied, without touching what a
reader has planned to read.  The log is small: one row per load and slice.  A
table has one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "rows"
ENTRY = "load STRING, part STRING, slice STRING, held BOOLEAN, runs ARRAY<STRING>, source STRING, schema STRING"


@dataclass(frozen=True)
class Slice:
    """What the log says last about a day or bucket of a part."""

    load: str
    held: bool
    runs: frozenset[str]
    source: str | None


@dataclass
class Load:
    """A finished but uncommitted write: the runs of each (part, slice), and what was observed on the way.

    Slices of ``replaced`` (by part) that were not seen become empty; ``sources``
    says what a slice was made from.
    """

    name: str
    seen: dict[tuple[str, Any], set[str]]
    schema: T.StructType
    metrics: dict = field(default_factory=dict)
    replaced: dict[str, set] = field(default_factory=dict)
    sources: dict[Any, str] = field(default_factory=dict)


class SlicedTable:
    """Rows with a column of dates or bucket numbers, in one or more parts that are loaded together.

    ``parse`` turns a slice's text, as in folder names, into its value.
    """

    def __init__(
        self, spark: SparkSession, path: str, column: str = "landed_on", parse: Callable[[str], Any] = dt.date.fromisoformat
    ) -> None:
        self._spark = spark
        self._path = path
        self.column = column
        self._parse = parse

    def _log(self) -> DataFrame | None:
        try:
            return self._spark.read.schema(ENTRY).json(f"{self._path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def state(self, part: str = ROWS) -> dict[Any, Slice]:
        """Each slice's latest entry, the emptied ones included: at most one row per slice comes to the driver."""
        log = self._log()
        if log is None:
            return {}
        entry = F.struct("load", "held", "runs", "source")
        last = log.filter(F.col("part") == part).groupBy("slice").agg(F.max_by(entry, "load").alias("e"))
        return {
            self._parse(row["slice"]): Slice(
                row["e"]["load"], row["e"]["held"], frozenset(row["e"]["runs"] or ()), row["e"]["source"]
            )
            for row in last.collect()
        }

    def _next(self) -> str:
        log = self._log()
        last = log.agg(F.max("load")).first()[0] if log is not None else None
        number = int(last.split("-")[0]) + 1 if last else 0
        # A load that died leaves a folder that no later load will use.
        return f"{number:012d}-{uuid.uuid4().hex[:8]}"

    def folder(self, load: str) -> str:
        return f"{self._path}/loads/load={load}"

    def write(
        self,
        rows: DataFrame,
        part: Column | None = None,
        run: Column | None = None,
        observed: Sequence[Column] = (),
    ) -> Load:
        """Write ``rows`` without showing them yet.

        Slices, runs and ``observed`` are gathered by the tasks that write, which
        Spark counts once each, also when an executor is lost before them.
        """
        name, seen = self._next(), Observation()
        named = rows.withColumn("part", F.lit(ROWS) if part is None else part)
        text = F.col(self.column).cast("string")
        who = F.struct("part", text.alias("slice"), (F.lit("") if run is None else run).alias("run"))
        dealt = named.hint("rebalance", "part", self.column)
        dealt.observe(seen, F.collect_set(who).alias("seen"), *observed).write.mode("overwrite").partitionBy(
            "part", self.column
        ).parquet(self.folder(name))
        metrics = dict(seen.get)
        slices: dict[tuple[str, Any], set[str]] = {}
        for row in metrics.pop("seen", None) or ():
            slices.setdefault((row["part"], self._parse(row["slice"])), set()).add(row["run"])
        return Load(name, slices, named.schema, metrics)

    def commit(self, load: Load) -> None:
        """Show a load."""
        schema = json.dumps(load.schema.jsonValue())
        entries = [
            (load.name, part, str(value), True, sorted(filter(None, runs)), load.sources.get(value), schema)
            for (part, value), runs in load.seen.items()
        ]
        for part, values in load.replaced.items():
            gone = values - {value for p, value in load.seen if p == part}
            entries += [(load.name, part, str(value), False, [], load.sources.get(value), schema) for value in gone]
        if entries:
            self._spark.createDataFrame(entries, ENTRY).coalesce(1).write.mode("append").json(f"{self._path}/commits")

    def read_load(self, load: Load) -> DataFrame:
        """The rows of one load, committed or not."""
        return self._spark.read.schema(load.schema).parquet(self.folder(load.name)).drop("part")

    def read(
        self, part: str = ROWS, only: Iterable | None = None, state: Mapping[Any, Slice] | None = None
    ) -> DataFrame:
        """The rows of all slices, or of some, as the log has them now; filters on the slice prune folders."""
        log = self._log()
        if log is None:
            raise FileNotFoundError(f"no finished load in {self._path}")
        held = self.state(part) if state is None else state
        wanted = held if only is None else {value: held[value] for value in only if value in held}
        schema = T.StructType.fromJson(json.loads(log.agg(F.max_by("schema", "load")).first()[0]))
        folders = [
            f"{self.folder(entry.load)}/part={part}/{self.column}={value}"
            for value, entry in sorted(wanted.items())
            if entry.held
        ]
        if not folders:
            return self._spark.createDataFrame([], schema).drop("part")
        reader = self._spark.read.schema(schema).option("basePath", f"{self._path}/loads")
        return reader.parquet(*folders).drop("part", "load")
