"""Registered queries: every relation over feeds derived from the benchmark tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import session
from .functions import star_tier
from .operators import asof_join, first_by, latest_by, number_runs, quality
from .plans import contracts, dims, facts, jobs, marts, reports, snapshot, staging
from .plans.build import build
from .plans.stores import DailyFacts, RepoHistory, VersionedTable
from .schemas import DEVELOPER_RECORD, RESOURCES, TRENDING_RECORD, WATCHED
from .sources import feeds, landing
from .sources.replacing import ReplacingTable
from .sources.sliced import SlicedTable
from .streaming import messages, records, sinks
from .streaming.totals import OwnerTotals

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Days and lists as text, so that two engines' results compare value by value."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def _staged(spark: SparkSession, sf_dir: str, resource: str, sorts: bool = False) -> DataFrame:
    return staging.stage(feeds.feed(spark, sf_dir, resource, sorts), resource)


def _repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "repositories")


def _prs(spark: SparkSession, sf_dir: str, sorts: bool = False) -> DataFrame:
    return _staged(spark, sf_dir, "pull_requests", sorts)


def _issues(spark: SparkSession, sf_dir: str, sorts: bool = False) -> DataFrame:
    return _staged(spark, sf_dir, "issues", sorts)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.repos_snapshot(_repos(spark, sf_dir))


def _complete_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of the repository feed, each of which lists all repositories."""
    landed = feeds.feed(spark, sf_dir, "repositories").select(
        F.col("_run_id").alias("run_id"), F.col("_extracted_at").alias("finished_at_utc")
    )
    return number_runs(landed)


def repos_snapshot_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history when every run lists all repositories, so that a vanished one is closed."""
    return snapshot.repos_snapshot(_repos(spark, sf_dir), _complete_runs(spark, sf_dir))


def _new_each_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories as daily searches list them: a run has those that are new or changed since they were listed last."""
    state = F.struct(*WATCHED)
    before = Window.partitionBy("repo_id").orderBy("run_id")
    marked = _repos(spark, sf_dir).withColumn("same", state.eqNullSafe(F.lag(state).over(before)))
    return marked.filter(~F.col("same")).drop("same")


def repos_snapshot_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of runs that list different repositories, taken in run by run from all rows so far."""
    staged = _new_each_day(spark, sf_dir)
    history = RepoHistory(spark, session.scratch_dir(spark, "history"))
    for run in range(1, feeds.RUNS + 1):
        so_far = staged.filter(F.col("run_id") <= f"run-{run}")
        history.apply(so_far, f"{run:03d}", F.lit(f"2026-06-0{1 + run} 00:00:00").cast("timestamp"))
    return history.read()


def repos_snapshot_daily_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, rebuilt in one pass."""
    return snapshot.repos_snapshot(_new_each_day(spark, sf_dir))


def _staged_from_json(resource: str) -> Query:
    """Staging over payloads delivered as JSON text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return staging.stage(feeds.payload_text(feeds.feed(spark, sf_dir, resource)), resource)

    return run


def lineitem_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    ties = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    return latest_by(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", ties)


def latest_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.latest_repos(_repos(spark, sf_dir))


def fact_repo_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_repo_snapshots(_repos(spark, sf_dir))


def fact_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_pull_requests(_prs(spark, sf_dir, sorts=True))


def fact_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_issues(_issues(spark, sf_dir, sorts=True))


def dim_developers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_developers(_repos(spark, sf_dir), _prs(spark, sf_dir), _issues(spark, sf_dir))


def dim_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.dim_repos(_history(spark, sf_dir))


def repos_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.repos_as_of(_history(spark, sf_dir), F.lit("2026-01-04 00:00:00").cast("timestamp"))


def version_at_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every listed repository, the version valid some hours before its update."""
    asked = F.timestamp_seconds(F.unix_seconds("updated_at") - (F.col("repo_id") % 48) * feeds.HOUR)
    rows = _repos(spark, sf_dir).select("repo_id", "run_id", asked.alias("asked_at"))
    versions = _history(spark, sf_dir).select(
        "repo_id", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id", F.col("stargazers_count").alias("valid_stars")
    )
    return asof_join(rows, versions, "repo_id", "asked_at", "dbt_valid_from", "dbt_valid_to")


def mart_trending_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_trending_repos(_history(spark, sf_dir))


def trending_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.trending_by_tier(mart_trending_repos(spark, sf_dir))


def mart_developer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_developer_activity(_history(spark, sf_dir))


def top_developers(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = mart_developer_activity(spark, sf_dir)
    return reports.top_developers(activity.withColumnRenamed("repos_created", "repos_count"))


def mart_community_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_community_health(_history(spark, sf_dir), _issues(spark, sf_dir), _prs(spark, sf_dir))


def community_health_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_community_health(
        _history(spark, sf_dir), _issues(spark, sf_dir), _prs(spark, sf_dir), dedup=True
    )


def repo_metrics_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.metrics_over_time(
        fact_repo_snapshots(spark, sf_dir), _history(spark, sf_dir), dims.dim_date(spark)
    )


def pull_requests_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pull_requests_by_day(fact_pull_requests(spark, sf_dir), dims.dim_date(spark))


def pull_requests_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pull_requests_by_owner(fact_pull_requests(spark, sf_dir), dim_repos(spark, sf_dir))


def search_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.search_repositories(
        _repos(spark, sf_dir), dt.date(2020, 2, 1), dt.date(2021, 6, 30), language="PROMO"
    )


def page_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages that repeat ids: the first occurrence in page order stays."""
    events = feeds.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.floor(F.col("event_id") / 100).alias("page"),
        (F.col("event_id") % 100).alias("position"),
        "event_type",
        "value",
    )
    return first_by(events, ["id"], ["page", "position"])


def repos_snapshot_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history, taken in run by run through the stored version table."""
    staged = _repos(spark, sf_dir)
    history = RepoHistory(spark, session.scratch_dir(spark, "history"))
    for run in range(1, feeds.RUNS + 1):
        listing = staged.filter(F.col("run_id") == f"run-{run}")
        history.apply(listing, f"2026060{1 + run}", F.lit(f"2026-06-0{1 + run} 00:00:00").cast("timestamp"))
    return history.read()


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut short or without a run, set aside while the others of their day are loaded."""
    base = session.scratch_dir(spark, "quarantine")
    envelopes = feeds.nested(feeds.feed(spark, sf_dir, "issues"))
    state, day = F.col("payload.state"), F.col("payload.created_at")
    options = {"timestampFormat": feeds.TIMESTAMP_TEXT}
    line = F.to_json(F.struct("_resource", "_run_id", "_extracted_at", "payload"), options)
    without_run = F.to_json(F.struct("_resource", "_extracted_at", "payload"), options)
    comments = F.col("payload.comments")
    text = F.when(comments.isNull(), F.left(line, F.length(line) - 2)).when(comments == 0, without_run).otherwise(line)
    folders = [F.date_format(day, f).alias(n) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))]
    envelopes.select(text.alias("value"), *folders).write.partitionBy("year", "month", "day").text(f"{base}/in/issues")
    start, end, loaded_at = dt.date(2024, 1, 1), dt.date(2024, 12, 31), F.lit("2026-06-05 00:00:00")
    jobs.load_days(spark, f"{base}/in", f"{base}/raw", start, end, loaded_at, ["issues"])
    loaded = landing.read_raw(spark, f"{base}/raw/issues").select("landed_on", F.lit("loaded").alias("outcome"))
    aside = landing.read_quarantine(spark, f"{base}/raw/issues").select(
        "landed_on", F.when(F.col("line").isNull(), "incomplete").otherwise("unreadable").alias("outcome")
    )
    return loaded.unionByName(aside).groupBy("landed_on", "outcome").agg(F.count("*").alias("lines"))


def loaded_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues delivered as lines of which some have an envelope and some are bare records, read by one loader."""
    path = session.scratch_dir(spark, "payloads")
    envelopes = feeds.nested(feeds.feed(spark, sf_dir, "issues"))
    options = {"timestampFormat": feeds.TIMESTAMP_TEXT}
    wrapped = F.to_json(F.struct("_resource", "_run_id", "_extracted_at", "payload"), options)
    bare = F.to_json("payload", options)
    closed = F.col("payload.state") == "closed"
    envelopes.select(F.when(closed, wrapped).otherwise(bare).alias("value")).write.text(path)
    part = lambda name, kind: F.try_variant_get("payload", f"$.{name}", kind).alias(name)
    return (
        landing.read_payloads(spark, path)
        .select(part("state", "string"), part("id", "bigint"), part("comments", "bigint"))
        .groupBy("state")
        .agg(F.count_distinct("id").alias("issues"), F.sum("comments").alias("comments"), F.max("id").alias("last_id"))
    )


def repos_snapshot_keep_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history when a repository that is not listed stays open."""
    staged = _repos(spark, sf_dir)
    history = RepoHistory(spark, session.scratch_dir(spark, "history"))
    for run in range(1, feeds.RUNS + 1):
        listing = staged.filter(F.col("run_id") == f"run-{run}")
        history.apply(listing, f"{run:03d}", F.lit(f"2026-06-0{1 + run} 00:00:00").cast("timestamp"), "ignore")
    return history.read()


def replacing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per user from a table written in two batches, with a merge between them."""
    events = feeds.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    table = ReplacingTable(spark, session.scratch_dir(spark, "events"), "user_id", ["ts", "event_id"])
    is_click = F.col("event_type") == "click"
    table.append(events.filter(is_click), 0)
    table.merge()
    table.append(events.filter(~is_click), 1)
    return table.read()


def backfilled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all landed days, then load a range of them again, and count the staged rows."""
    base = session.scratch_dir(spark, "backfill")
    landing.write(feeds.nested(feeds.feed(spark, sf_dir, "repositories")), base, "repositories")
    raw, loaded_at = f"{base}/raw", F.lit("2026-06-05 00:00:00").cast("timestamp")
    first, second, third = (dt.date(2026, 6, d) for d in (2, 3, 4))
    jobs.load_days(spark, base, raw, first, third, loaded_at, ["repositories"])
    jobs.load_days(spark, base, raw, second, third, loaded_at, ["repositories"])
    staged = staging.stage_repositories(jobs.raw_tables(spark, raw, ["repositories"])["repositories"])
    return staged.groupBy("run_id").agg(
        F.count("*").alias("repos"),
        F.count_distinct("repo_id").alias("ids"),
        F.sum("stargazers_count").alias("stars"),
        F.count_if(F.array_contains("topics", "red")).alias("red"),
        F.max("updated_at").alias("last_update"),
    )


def _land_run(spark: SparkSession, sf_dir: str, base: str, run: int) -> dt.date:
    """Land the repositories of one run under its day."""
    day = dt.date(2026, 6, 1 + run)
    listed = feeds.nested(feeds.feed(spark, sf_dir, "repositories")).filter(F.col("_run_id") == f"run-{run}")
    landing.replace_day(listed, base, "repositories", day)
    return day


def incremental_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository facts by landed day: three days landed, loaded and built in turn, then one of them once more."""
    base = session.scratch_dir(spark, "incremental")
    raw = SlicedTable(spark, f"{base}/raw/repositories")
    made = DailyFacts(spark, f"{base}/facts", "repositories")
    for run in (1, 2, 3, 2):
        day = _land_run(spark, sf_dir, f"{base}/in", run)
        jobs.load_days(spark, f"{base}/in", f"{base}/raw", day, day, F.lit("2026-06-05 00:00:00"), ["repositories"])
        made.commit(made.write(raw))
    return made.read().drop(DailyFacts.DAY)


def daily_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day since the first partition, and the runs and records that are loaded for it."""
    base = session.scratch_dir(spark, "partitions")
    landing.write(feeds.nested(feeds.feed(spark, sf_dir, "repositories")), f"{base}/in", "repositories")
    jobs.load_days(spark, f"{base}/in", f"{base}/raw", None, None, F.lit("2026-06-05 00:00:00"), ["repositories"])
    return jobs.partition_status(spark, f"{base}/raw/repositories", dt.date(2026, 6, 5))


def _issues_with_misfits(spark: SparkSession, sf_dir: str, sorts: bool = False) -> DataFrame:
    """Issues as JSON text in which some counts are words."""
    raw = feeds.payload_text(feeds.feed(spark, sf_dir, "issues", sorts))
    return raw.withColumn("payload", F.regexp_replace("payload", '"comments":0', '"comments":"none"'))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build with every rule evaluated; the feeds break some of them on purpose."""
    raw = {r: feeds.feed(spark, sf_dir, r, sorts=True) for r in RESOURCES}
    raw["issues"] = _issues_with_misfits(spark, sf_dir, sorts=True)
    return build(spark, raw, session.scratch_dir(spark, "warehouse"), "20260604", gate=False).quality


def dq_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source contract on the payloads as delivered."""
    parts = [
        quality.evaluate(r, feeds.nested(feeds.feed(spark, sf_dir, r)).select("payload.*"), contracts.SOURCE_RULES[r])
        for r in RESOURCES
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def dq_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of issues that do not fit their column, in payloads of which some are broken."""
    return staging.misfits(_issues_with_misfits(spark, sf_dir), "issues")


def dq_negative_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The no-negative-values rule on tables that hold some."""
    checks = {"customer": "c_acctbal", "supplier": "s_acctbal", "lineitem": "l_quantity"}
    parts = [
        quality.evaluate(t, feeds.table(spark, sf_dir, t), [quality.not_negative(c)]) for t, c in checks.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def event_json_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalars taken out of JSON text, a missing one as 0, classified and counted."""
    events = feeds.table(spark, sf_dir, "events")
    stars = F.coalesce(F.get_json_object("props", "$.k"), F.lit("0")).try_cast("bigint")
    absent = F.coalesce(F.get_json_object("props", "$.absent"), F.lit("0")).try_cast("bigint")
    return (
        events.select("event_type", star_tier(stars * 15).alias("star_tier"), stars.alias("k"), absent.alias("z"))
        .groupBy("event_type", "star_tier")
        .agg(F.count("*").alias("n"), F.sum("k").alias("sum_k"), F.sum("z").alias("sum_absent"))
    )


def _landed(spark: SparkSession, sf_dir: str, resource: str, run_scoped: bool = False) -> str:
    base = session.scratch_dir(spark, "landing")
    landing.write(feeds.nested(feeds.feed(spark, sf_dir, resource)), base, resource, run_scoped=run_scoped)
    return base


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land repositories as JSON lines, load them into the raw table, stage them from there."""
    base = _landed(spark, sf_dir, "repositories")
    raw_path = session.scratch_dir(spark, "raw")
    loaded_at = F.lit("2026-06-05 00:00:00").cast("timestamp")
    landing.write_raw(landing.to_raw(landing.read(spark, base, "repositories"), loaded_at), raw_path)
    return staging.stage_repositories(landing.read_raw(spark, raw_path)).drop("airbyte_raw_id")


def _listed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories as result pages list them: three pages, on which ids come again."""
    listed = feeds.nested(feeds.feed(spark, sf_dir, "repositories"))
    return listed.select("payload.*", F.right("_run_id", F.lit(1)).alias("page"), F.col("payload.id").alias("position"))


def landed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day landed from pages that repeat ids, loaded and staged; its manifest row beside what came of it."""
    base = session.scratch_dir(spark, "landed")
    day, at = dt.date(2026, 6, 2), dt.datetime(2026, 6, 2, 6, tzinfo=dt.timezone.utc)
    manifest = jobs.land_day({"repositories": _listed_pages(spark, sf_dir)}, day, base, "day-1", at, ["repositories"])
    jobs.load_days(spark, base, f"{base}/raw", day, day, F.lit("2026-06-02 06:30:00"), ["repositories"])
    staged = staging.stage_repositories(jobs.raw_tables(spark, f"{base}/raw", ["repositories"])["repositories"])
    loaded = staged.groupBy("run_id").agg(
        F.count("*").alias("repos"),
        F.count_distinct("repo_id").alias("ids"),
        F.sum("stargazers_count").alias("stars"),
        F.max("updated_at").alias("last_update"),
    )
    summary = landing.run_summary(manifest).select("run_id", "resources", "records", "started_at_utc", "finished_at_utc")
    files = manifest.select("run_id", "date", (F.size("files") > 0).alias("has_files"))
    return loaded.join(summary, "run_id").join(files, "run_id")


def emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day landed and loaded, then landed again without records: its manifest rows and what is loaded."""
    base = session.scratch_dir(spark, "emptied")
    day, pages = dt.date(2026, 6, 2), _listed_pages(spark, sf_dir)
    states = []
    for run, items in (("day-1", pages), ("day-1-again", pages.filter(F.lit(False)))):
        at = dt.datetime(2026, 6, 2, 6, tzinfo=dt.timezone.utc)
        manifest = jobs.land_day({"repositories": items}, day, base, run, at, ["repositories"])
        jobs.load_days(spark, base, f"{base}/raw", None, None, F.lit("2026-06-02 06:30:00"), ["repositories"])
        loaded = jobs.raw_tables(spark, f"{base}/raw", ["repositories"])["repositories"].count()
        told = manifest.select("resource", "run_id", "date", "records", "started_at_utc", F.lit(loaded).alias("loaded"))
        states.append(VersionedTable(spark, f"{base}/{run}").replace(told, "1"))
    return states[0].unionByName(states[1])


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land three days, land one of them again, and count what is there."""
    base = _landed(spark, sf_dir, "repositories")
    again = feeds.nested(feeds.feed(spark, sf_dir, "repositories")).filter(F.col("_run_id") == "run-2")
    landing.write(again, base, "repositories")
    return landing.manifest(landing.read(spark, base, "repositories"))


def run_scoped_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-scoped landing of issues, read back as one tree of files."""
    return landing.manifest(landing.read_tree(spark, _landed(spark, sf_dir, "issues", run_scoped=True)))


def _repo_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = feeds.nested(feeds.feed_stream(spark, sf_dir, "repositories"))
    return messages.envelope_messages(envelopes)


# The later message wins, of messages of one time the one that stands later in its source.
LATEST = ["event_time", messages.POSITION]


def _drain(spark: SparkSession, rows: DataFrame, key, order: list[str], label: str, **options) -> ReplacingTable:
    """Run a stream over everything available into a new replacing table."""
    base = session.scratch_dir(spark, label)
    table = ReplacingTable(spark, f"{base}/table", key, order)
    if "record" in options:
        options.setdefault("dead_letters", f"{base}/dead-letters")
    sinks.upsert(rows, table, f"{base}/checkpoint", **options).awaitTermination()
    return table


def _trending_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = messages.parse_repositories(_repo_messages(spark, sf_dir))
    rows = records.trending(parsed, F.col("row_time"))
    return _drain(spark, rows, "repo_id", LATEST, "trending", record=TRENDING_RECORD).read()


def stream_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.as_served(_trending_table(spark, sf_dir), TRENDING_RECORD)


def stream_trending_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.trending_by_tier(_trending_table(spark, sf_dir))


def stream_developer_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last record per owner, as a table that replaces by owner holds it; all records of a run have one time."""
    rows = records.developer_activity(messages.parse_repositories(_repo_messages(spark, sf_dir)))
    table = _drain(spark, rows, "owner_login", LATEST, "developers", record=DEVELOPER_RECORD)
    return records.as_served(table.read(), DEVELOPER_RECORD)


def stream_developer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.owner_totals(_trending_table(spark, sf_dir))


def stream_top_developers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_developers(stream_developer_totals(spark, sf_dir))


def stream_owner_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = messages.parse_repositories(_repo_messages(spark, sf_dir))
    rows = records.windowed_owner_totals(parsed, late="7 days")
    keys = ["window_start", "owner_login"]
    return _drain(spark, rows, keys, ["repos_count"], "windows", output_mode="update").read()


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows, each written once: a heartbeat after the last message closes the last of them."""
    beats = session.scratch_dir(spark, "heartbeats")
    last = _repos(spark, sf_dir).agg(F.max("extracted_at").alias("at"))
    last.select(F.timestamp_seconds(F.unix_seconds("at") + 30 * feeds.DAY).alias("row_time")).write.parquet(beats)
    heartbeats = spark.readStream.schema("row_time TIMESTAMP").parquet(beats)
    parsed = messages.parse_repositories(_repo_messages(spark, sf_dir))
    rows = records.windowed_owner_totals(parsed, late="7 days", heartbeats=heartbeats)
    return _drain(spark, rows, ["window_start", "owner_login"], ["repos_count"], "closed").read()


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of landed files read a file at a time by a query that ends and is started again; counted per owner."""
    base = session.scratch_dir(spark, "resumed")
    table = ReplacingTable(spark, f"{base}/table", "line", ["event_time"])
    for runs in ((1, 2), (3,)):
        for run in runs:
            _land_run(spark, sf_dir, f"{base}/in", run)
        lines = messages.file_messages(spark, f"{base}/in/repositories", max_files=1)
        parsed = messages.parse_repositories(lines)
        rows = parsed.select(
            F.md5("value").alias("line"), "owner_login", "stargazers_count", F.col("row_time").alias("event_time")
        )
        sinks.upsert(rows, table, f"{base}/checkpoint").awaitTermination()
    return table.read_all().groupBy("owner_login").agg(
        F.count("*").alias("deliveries"), F.sum("stargazers_count").alias("stars")
    )


def stream_owner_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per owner, changed batch by batch: a run's files are one batch or more."""
    base = session.scratch_dir(spark, "changes")
    table = ReplacingTable(spark, f"{base}/table", "repo_id", LATEST)
    totals = OwnerTotals(spark, f"{base}/totals", table)
    for run in range(1, feeds.RUNS + 1):
        _land_run(spark, sf_dir, f"{base}/in", run)
        parsed = messages.parse_repositories(messages.file_messages(spark, f"{base}/in/repositories"))
        rows = records.trending(parsed, F.col("row_time"))
        options = {"record": TRENDING_RECORD, "dead_letters": f"{base}/letters", "merge_every": 2, "totals": totals}
        sinks.upsert(rows, table, f"{base}/checkpoint", **options).awaitTermination()
    return totals.read()


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that break the contract, counted by the fields they lack."""
    source = spark.readStream.schema(feeds.table(spark, sf_dir, "events").schema)
    events = source.parquet(f"{sf_dir}/events.parque[t]")
    payload = F.struct(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"),
        F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("repo-"), "user_id")).alias("full_name"),
        F.when(F.col("event_type") == "view", "many").otherwise(F.col("user_id").cast("string")).alias("stargazers_count"),
    )
    value = F.to_json(F.struct(payload.alias("payload"))).cast("binary")
    rows = events.select(F.lit(None).cast("binary").alias("key"), value.alias("value"), F.col("ts").alias("timestamp"))
    trending = records.trending(messages.parse_repositories(rows), F.col("row_time"))
    letters = session.scratch_dir(spark, "dead-letters")
    _drain(spark, trending, "repo_id", ["event_time"], "strict", record=TRENDING_RECORD, dead_letters=letters)
    return (
        spark.read.parquet(letters)
        .groupBy(F.array_join("missing", ",").alias("missing"))
        .agg(F.count("*").alias("messages"))
    )


def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice; counted once per owner and day."""
    source = spark.readStream.schema(feeds.table(spark, sf_dir, "events").schema)
    events = source.parquet(f"{sf_dir}/events.parque[t]")
    payload = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.concat(F.lit("owner"), "user_id").alias("login")).alias("owner"),
        F.col("event_id").alias("stargazers_count"),
    )
    twice = events.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(payload.alias("payload"))).cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    once = messages.parse_repositories(messages.drop_redelivered(twice, within="60 days"))
    rows = once.select("repo_id", "owner_login", "stargazers_count", F.col("row_time").alias("event_time"))
    table = _drain(spark, rows, "repo_id", ["event_time"], "once").read_all()
    return table.groupBy("owner_login").agg(
        F.count("*").alias("deliveries"), F.sum("stargazers_count").alias("stars")
    )


REGISTERED: dict[str, Query] = {
    "stg_repositories": _staged_from_json("repositories"),
    "stg_pull_requests": _staged_from_json("pull_requests"),
    "stg_issues": _staged_from_json("issues"),
    "fact_repo_snapshots": fact_repo_snapshots,
    "fact_pull_requests": fact_pull_requests,
    "fact_issues": fact_issues,
    "lineitem_latest": lineitem_latest,
    "latest_repos": latest_repos,
    "dim_developers": dim_developers,
    "repos_snapshot": _history,
    "dim_repos": dim_repos,
    "repos_as_of": repos_as_of,
    "version_at_update": version_at_update,
    "mart_trending_repos": mart_trending_repos,
    "trending_by_tier": trending_by_tier,
    "mart_developer_activity": mart_developer_activity,
    "top_developers": top_developers,
    "mart_community_health": mart_community_health,
    "community_health_dedup": community_health_dedup,
    "repo_metrics_over_time": repo_metrics_over_time,
    "pull_requests_by_day": pull_requests_by_day,
    "pull_requests_by_owner": pull_requests_by_owner,
    "search_repositories": search_repositories,
    "page_dedup": page_dedup,
    "repos_snapshot_by_run": repos_snapshot_by_run,
    "repos_snapshot_keep_deleted": repos_snapshot_keep_deleted,
    "repos_snapshot_complete": repos_snapshot_complete,
    "repos_snapshot_daily": repos_snapshot_daily,
    "repos_snapshot_daily_rebuilt": repos_snapshot_daily_rebuilt,
    "replacing_events": replacing_events,
    "backfilled_days": backfilled_days,
    "quarantined_lines": quarantined_lines,
    "loaded_payloads": loaded_payloads,
    "incremental_build": incremental_build,
    "daily_partitions": daily_partitions,
    "dq_report": dq_report,
    "dq_source": dq_source,
    "dq_casts": dq_casts,
    "dq_negative_values": dq_negative_values,
    "event_json_classify": event_json_classify,
    "landing_roundtrip": landing_roundtrip,
    "run_manifest": run_manifest,
    "landed_day": landed_day,
    "emptied_day": emptied_day,
    "run_scoped_manifest": run_scoped_manifest,
    "stream_trending": stream_trending,
    "stream_trending_by_tier": stream_trending_by_tier,
    "stream_developer_latest": stream_developer_latest,
    "stream_developer_totals": stream_developer_totals,
    "stream_top_developers": stream_top_developers,
    "stream_owner_windows": stream_owner_windows,
    "stream_closed_windows": stream_closed_windows,
    "stream_resumed": stream_resumed,
    "stream_owner_changes": stream_owner_changes,
    "stream_dead_letters": stream_dead_letters,
    "stream_redelivered": stream_redelivered,
}


def queries() -> dict[str, Query]:
    def entry_for(query: Query) -> Query:
        return lambda spark, sf_dir: portable(query(session.prepare(spark), sf_dir))

    return {name: entry_for(query) for name, query in REGISTERED.items()}
