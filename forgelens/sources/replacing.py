"""A keyed table that keeps the last row written per key."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import latest_by
from .commits import CommitLog, write_folder
from .sliced import ROWS, SlicedTable

_BATCH = "__batch"
_BUCKET = "__bucket"
BUCKETS = 16


def _tag(number: int) -> str:
    return f"{number:019d}"


class ReplacingTable:
    """Upserts as appended batches, reduced to one row per key when read.

    A batch costs its own size, not the table's.  It goes to a folder named by
    its number, so a batch that is delivered again replaces itself.  ``merge``
    folds the batches into a base that is kept by hash of the key: only buckets
    that the batches hold keys of are written again, and a reader reduces these
    alone; the others, and a base without later batches, are read as they are.

    Of rows that are equally late by ``order`` the later batch wins, then the
    greater content.  A table has one writer at a time, which reads the commit
    log once, and one number of ``buckets`` for good.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str | Sequence[str], order: Sequence[str], buckets: int = BUCKETS
    ) -> None:
        self._spark = spark
        self._path = path
        self.keys = [key] if isinstance(key, str) else list(key)
        self._order = list(order)
        self._buckets = buckets
        self._batches = CommitLog(spark, f"{path}/commits")
        self._base = SlicedTable(spark, f"{path}/base", _BUCKET, int)
        self._written: str | None = None

    def last_per_key(self, df: DataFrame, *ties: str) -> DataFrame:
        # Rows that are equally late are told apart by their content, whatever order they come in.
        first, *rest = self._order
        named = {*self.keys, *self._order, *ties, _BUCKET}
        content = [c for c, kind in df.dtypes if c not in named and not kind.startswith(("map", "variant"))]
        return latest_by(df, self.keys, first, [*rest, *ties, *content])

    def append(self, batch: DataFrame, number: int) -> None:
        if self._written is None:
            self._written = self._batches.last() or ""
        tag, seen = _tag(number), Observation()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self._buckets)).cast("int")
        rows = self.last_per_key(batch).withColumn(_BUCKET, bucket)
        touched = F.collect_set(_BUCKET).alias("touched")
        write_folder(rows.observe(seen, touched), f"{self._path}/batches/{_BATCH}={tag}")
        if self._written < tag:
            self._batches.add(tag, seen.get.get("touched") or [])
            self._written = tag

    def _open(self, before: int | None = None) -> tuple[Mapping, str, dict[str, list[int]]]:
        """The base's buckets, the last batch in it, and the later batches with the buckets they touch."""
        state = self._base.state()
        merged, *others = {entry.source.split(":")[1] for entry in state.values()} or {str(self._buckets)}
        if others or int(merged) != self._buckets:
            raise ValueError(f"{self._path} is kept in {merged} buckets")
        last = max((entry.source.split(":")[0] for entry in state.values()), default="")
        limit = None if before is None else _tag(before)
        if limit is not None and last >= limit:
            raise ValueError(f"batch {before} is part of the base of {self._path}")
        return state, last, self._batches.between(last, limit)

    def _recent(self, tags: Iterable[str]) -> DataFrame:
        folders = f"{self._path}/batches"
        rows = self._spark.read.option("basePath", folders).parquet(*[f"{folders}/{_BATCH}={tag}" for tag in tags])
        # Zero-padded numbers would be read as integers: the folder column is text.
        return rows.withColumn(_BATCH, F.lpad(F.col(_BATCH).cast("string"), 19, "0"))

    def _reduced(self, state: Mapping, last: str, batches: Mapping[str, list[int]]) -> DataFrame:
        """Last rows per key of the buckets that ``batches`` touch."""
        rows = self._recent(batches)
        if state:
            touched = {bucket for found in batches.values() for bucket in found}
            old = self._base.read(only=touched, state=state).withColumn(_BATCH, F.lit(last))
            rows = old.unionByName(rows)
        return self.last_per_key(rows, _BATCH).drop(_BATCH)

    def read_all(self) -> DataFrame:
        """Every row still stored, with the number of its batch."""
        state, last, batches = self._open()
        parts = [self._base.read(state=state).withColumn(_BATCH, F.lit(last))] if state else []
        parts += [self._recent(batches)] if batches else []
        if not parts:
            raise FileNotFoundError(f"no finished batch in {self._path}")
        return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).drop(_BUCKET)

    def read(self, before: int | None = None) -> DataFrame:
        """The last row per key, of all batches or of those ``before`` one that is not merged yet."""
        state, last, batches = self._open(before)
        if not state and not batches:
            raise FileNotFoundError(f"no finished batch in {self._path}")
        if not batches:
            return self._base.read(state=state).drop(_BUCKET)
        reduced = self._reduced(state, last, batches)
        untouched = set(state) - {bucket for found in batches.values() for bucket in found}
        if untouched:
            reduced = self._base.read(only=untouched, state=state).unionByName(reduced)
        return reduced.drop(_BUCKET)

    def has(self, before: int | None = None) -> bool:
        """Whether there is anything to read."""
        state, _, batches = self._open(before)
        return bool(state or batches)

    def is_merged(self, number: int) -> bool:
        """Whether a batch of this number, or a later one, is part of the base."""
        return self._open()[1] >= _tag(number)

    def merge(self) -> None:
        state, last, batches = self._open()
        if not batches:
            return
        load = self._base.write(self._reduced(state, last, batches))
        touched = {bucket for found in batches.values() for bucket in found}
        load.replaced = {ROWS: touched}
        load.sources = {bucket: f"{max(batches)}:{self._buckets}" for bucket in touched}
        self._base.commit(load)
