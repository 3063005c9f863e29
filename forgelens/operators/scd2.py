"""Type-2 history: one row per version of a key, with a validity interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import version_key
from ..schemas import VALID_FROM, VALID_TO, VERSION_ID, VERSION_UPDATED
from .latest import latest_by

STATE = "state"


def _check_deletes(hard_deletes: str) -> None:
    if hard_deletes not in ("close", "ignore"):
        raise ValueError("hard_deletes must be 'close' or 'ignore'")


def _as_version(rows: DataFrame, key: str, valid_to: Column) -> DataFrame:
    """Turn staged rows into versions that start at the row's own change time."""
    started = F.coalesce(F.col("updated_at"), F.col("extracted_at"))
    return rows.select(
        *[c for c in rows.columns if not c.startswith("__")],
        version_key(key, "updated_at", "run_id").alias(VERSION_ID),
        started.alias(VERSION_UPDATED),
        started.alias(VALID_FROM),
        valid_to.cast("timestamp").alias(VALID_TO),
    )


def advance(
    open_versions: DataFrame | None,
    incoming: DataFrame,
    key: str,
    watched: Sequence[str],
    run_ts: Column,
    hard_deletes: str = "close",
) -> DataFrame:
    """One run: the open versions after it and the versions it closed, told apart by ``state``.

    ``incoming`` has one row per key.  Closed versions never change again, so a
    run costs one join of the open versions with the listing, however long the
    history is.  An unchanged key keeps its open version as it is; a key that
    is not listed is closed at ``run_ts`` (or kept, with ``"ignore"``).
    """
    _check_deletes(hard_deletes)
    fresh = _as_version(incoming.filter(F.col(key).isNotNull()), key, F.lit(None))
    if open_versions is None:
        return fresh.withColumn(STATE, F.lit("open"))
    columns = fresh.columns
    old = open_versions.select(F.col(key).alias("__key"), F.struct(*columns).alias("__old"))
    new = fresh.select(F.col(key).alias("__key"), F.struct(*columns).alias("__new"))
    both = old.join(new, "__key", "full_outer")

    is_open, is_listed = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    moved = ~F.struct(*[F.col(f"__old.{c}") for c in watched]).eqNullSafe(
        F.struct(*[F.col(f"__new.{c}") for c in watched])
    )
    ends = is_open & F.when(is_listed, moved).otherwise(F.lit(hard_deletes == "close"))
    starts = is_listed & (~is_open | moved)

    def version(source: str, state: str, **changed: Column) -> Column:
        values = [changed.get(c, F.col(f"{source}.{c}")).alias(c) for c in columns]
        return F.struct(*values, F.lit(state).alias(STATE))

    # Up to two versions come out of a joined pair, so the join runs once.
    ended_at = F.when(is_listed, F.col(f"__new.{VALID_FROM}")).otherwise(run_ts)
    produced = F.array(
        F.when(ends, version("__old", "closed", **{VALID_TO: ended_at})).when(is_open, version("__old", "open")),
        F.when(starts, version("__new", "open")),
    )
    return both.select(F.inline(F.filter(produced, lambda v: v.isNotNull())))


def number_runs(manifest: DataFrame, moment: str = "finished_at_utc") -> DataFrame:
    """``(__run, run_id, run_ts)``: the runs of a manifest (at least one row per run) in time order."""
    runs = manifest.groupBy("run_id").agg(F.max(moment).alias("run_ts"))
    order = Window.orderBy(F.col("run_ts").asc_nulls_first(), "run_id")
    return runs.select(F.row_number().over(order).cast("bigint").alias("__run"), "run_id", "run_ts")


def replay(
    staged: DataFrame, key: str, watched: Sequence[str], ties: Sequence[str], complete_runs: DataFrame | None = None
) -> DataFrame:
    """The history that :func:`advance` builds run by run, in one pass over all runs.

    A run may list only what was new that day, so a key that it does not list
    is still there: a version ends when a later row of its key differs, and the
    last one stays open.  Rows whose run is unknown take part by their time.

    Where every run lists all keys, ``complete_runs`` (from :func:`number_runs`)
    says so: then a key that a run does not list is closed at that run.  A row
    whose run is not among them has no place in that order and fails the job.

    Used for a rebuild: one exchange on (key, run) to pick the row of each run
    and one on the key to compare neighbours, whatever the number of runs.  A
    key has at most one row per run by then, so no group is larger than the
    number of runs.
    """
    listed = latest_by(staged.filter(F.col(key).isNotNull()), [key, "run_id"], "extracted_at", ties)
    state = F.struct(*watched)
    start = F.coalesce("updated_at", "extracted_at")
    if complete_runs is None:
        in_time = Window.partitionBy(key).orderBy(F.col("extracted_at").asc_nulls_first(), "run_id")
        changes = listed.withColumns(
            {"__first": F.row_number().over(in_time) == 1, "__same": state.eqNullSafe(F.lag(state).over(in_time))}
        ).filter(F.col("__first") | ~F.col("__same"))
        return _as_version(changes.withColumn("__next_start", F.lead(start).over(in_time)), key, F.col("__next_start"))
    by_run = Window.partitionBy(key).orderBy("__run")
    unknown = F.raise_error(F.concat(F.lit("a row's run is not among the complete runs: "), F.coalesce("run_id", F.lit("null"))))
    starts = (
        # All windows share one exchange and one sort.
        listed.join(complete_runs.select("__run", "run_id"), "run_id", "left")
        .withColumn("__run", F.coalesce("__run", unknown.cast("bigint")))
        .withColumns(
            {
                "__before": F.lag("__run").over(by_run),
                "__same": state.eqNullSafe(F.lag(state).over(by_run)),
                "__final": F.max("__run").over(Window.partitionBy(key)),
            }
        )
        .filter(F.col("__before").isNull() | (F.col("__before") < F.col("__run") - 1) | ~F.col("__same"))
        .withColumns(
            {
                "__next": F.lead("__run").over(by_run),
                "__next_start": F.lead(start).over(by_run),
                # The last run that listed this version.
                "__last": F.coalesce(F.lead("__before").over(by_run), "__final"),
            }
        )
    )
    # Not listed in the run after its last one: closed when that run took place.
    missed = complete_runs.select((F.col("__run") - 1).alias("__last"), F.col("run_ts").alias("__missed_at"))
    replaced = F.col("__next") == F.col("__last") + 1
    ended = F.when(replaced, F.col("__next_start")).otherwise(F.col("__missed_at"))
    return _as_version(starts.join(missed, "__last", "left"), key, ended)


def current(history: DataFrame) -> DataFrame:
    """Open versions only."""
    return history.filter(F.col(VALID_TO).isNull())


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """The versions that were valid at ``moment``."""
    is_over = F.col(VALID_TO) <= moment
    return history.filter((F.col(VALID_FROM) <= moment) & ~F.coalesce(is_over, F.lit(False)))
