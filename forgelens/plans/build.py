"""The whole build: every table in dependency order, checked before anything uses it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.util import inheritable_thread_target

from ..operators.quality import RESULT, Rule, counters, evaluate, stop_on_errors
from ..schemas import RESOURCES
from ..session import shuffles_released
from ..sources.sliced import SlicedTable
from . import dims, marts, snapshot
from .contracts import CAST_RULES, TABLE_RULES
from .facts import FACTS, shares
from .staging import stage
from .stores import DailyFacts, RepoHistory, VersionedTable

# Tables built at the same time.
THREADS = 4
# Staged rows that become facts at a time: what is shuffled for them is on the disks at once.
SHARE_ROWS = 40_000_000


@dataclass
class Build:
    """Tables of one build and the outcome of their rules (at most one row per rule)."""

    spark: SparkSession
    warehouse: str
    tag: str
    gate: bool = True
    tables: dict[str, DataFrame] = field(default_factory=dict)
    outcomes: list[Row] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)

    def check(self, name: str, df: DataFrame, rules: Sequence[Rule], counted: Mapping[str, int] | None = None) -> None:
        rows = evaluate(name, df, rules, self.tables, counted).collect()
        self.outcomes += rows
        # Some rule looks at every row of its table.
        self.rows[name] = max(r.n_checked for r in rows)
        if self.gate:
            stop_on_errors([r for r in rows if not r.passed])

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """A table in one part."""
        return self.store_parts(name, [df])

    def store_parts(self, name: str, parts: Sequence[DataFrame]) -> DataFrame:
        """Write, check, and only then show the table to readers.

        Parts are written one after another.  Row rules are observed by the
        tasks that write, so no second read counts them.
        """
        table, rules = VersionedTable(self.spark, f"{self.warehouse}/{name}"), TABLE_RULES[name]
        seen = [Observation() for _ in parts]
        first, *more = [part.observe(s, *counters(rules)) for part, s in zip(parts, seen, strict=True)]
        self.tables[name] = table.write(first, self.tag, *more)
        counted: Counter[str] = Counter()
        for part in seen:
            counted.update(part.get)
        self.check(name, self.tables[name], rules, counted)
        table.commit(self.tag)
        return self.tables[name]

    def store_days(self, name: str, resource: str, raw: SlicedTable) -> DataFrame:
        """Write, check and show the days of a fact table that were loaded since its last build."""
        table, rules = DailyFacts(self.spark, f"{self.warehouse}/{name}", resource), TABLE_RULES[name]
        written = table.write(raw, counters(rules))
        if written is not None:
            self.check(name, table.read_load(written), rules, written.metrics)
            table.commit(written)
        self.tables[name] = table.read()
        return self.tables[name]

    def view(self, name: str, df: DataFrame, checked: DataFrame | None = None, rules: Sequence[Rule] = ()) -> DataFrame:
        """Check a relation that is not stored, by ``checked`` where that says more about it than it does."""
        self.tables[name] = df
        self.check(name, df if checked is None else checked, [*TABLE_RULES[name], *rules])
        return df

    def level(self, *groups: Mapping[str, Callable[..., DataFrame]]) -> None:
        """Steps that do not depend on each other: those of a group as jobs that run side by side, a group at a time."""
        done = []
        for steps in groups:
            with ThreadPoolExecutor(max_workers=min(len(steps), THREADS)) as pool:
                done += [pool.submit(inheritable_thread_target(self.spark)(step), name) for name, step in steps.items()]
        for step in done:
            step.result()

    @property
    def quality(self) -> DataFrame:
        return self.spark.createDataFrame(self.outcomes, f"{RESULT}, passed BOOLEAN")


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    warehouse: str,
    tag: str,
    run_ts: Column | None = None,
    gate: bool = True,
    landed: Mapping[str, SlicedTable] | None = None,
) -> Build:
    """Stage, historize and rebuild every table below ``warehouse``.

    ``raw`` holds all rows loaded so far.  With ``run_ts`` the stored history
    advances by one run, in which a repository that ``raw`` no longer has is
    closed; without it the history is rebuilt from all runs.  The first failed
    ``error`` rule stops the build before the table is shown to readers, unless
    ``gate`` is off.  With ``landed``, the raw tables by day, the facts are stored
    by day, and only days that were loaded since the last build are made and checked.
    """
    out = Build(spark, warehouse, tag, gate)
    with shuffles_released(spark):
        _build(out, raw, run_ts, landed)
    return out


def _build(
    out: Build, raw: Mapping[str, DataFrame], run_ts: Column | None, landed: Mapping[str, SlicedTable] | None
) -> None:
    staged = {r: stage(raw[r], r) for r in RESOURCES}
    flagged = {r: stage(raw[r], r, flagged=True) for r in RESOURCES}
    out.level(
        {
            f"stg_{r}": partial(out.view, df=df, checked=flagged[r], rules=CAST_RULES[f"stg_{r}"])
            for r, df in staged.items()
        }
    )
    repos, prs, issues = (staged[r] for r in RESOURCES)

    if run_ts is None:
        history = out.store("repos_snapshot", snapshot.repos_snapshot(repos))
    else:
        kept = RepoHistory(out.spark, f"{out.warehouse}/repos_history")
        history = out.view("repos_snapshot", kept.write(repos, out.tag, run_ts))
        kept.commit(out.tag)

    dimensions = {
        "dim_date": dims.dim_date(out.spark),
        "dim_repos": snapshot.dim_repos(history),
        "dim_developers": dims.dim_developers(repos, prs, issues),
    }
    reduced = {
        "mart_trending_repos": partial(out.store, df=marts.mart_trending_repos(history)),
        "mart_developer_activity": partial(out.store, df=marts.mart_developer_activity(history)),
        "mart_community_health": partial(out.store, df=marts.mart_community_health(history, issues, prs)),
    }
    whole = {}
    for resource, (name, make) in FACTS.items():
        if landed is None:
            count = -(-out.rows[f"stg_{resource}"] // SHARE_ROWS)
            whole[name] = partial(out.store_parts, parts=[make(s) for s in shares(staged[resource], resource, count)])
        else:
            whole[name] = partial(out.store_days, resource=resource, raw=landed[resource])
    out.level({name: partial(out.store, df=df) for name, df in dimensions.items()})
    # Facts shuffle whole records, and have the disks to themselves.
    out.level(reduced, whole)
