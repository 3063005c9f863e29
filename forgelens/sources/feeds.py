"""Repository, pull-request and issue feeds derived from the benchmark tables.

The benchmark tables hold no code-hosting records, so each feed maps the whole
of one table to envelopes: ``part`` to three daily listings of repositories,
``lineitem`` to pull requests, ``events`` to issues.  Every feed is a plain
projection (no join), so unused payload fields are pruned and the Parquet scan
reads only the columns a query needs.

A file may hold all rows in one piece, which one task would read.  Rows that
become wide or many are therefore dealt over as many tasks as their number asks
for, while they are still narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOADED_AT, RAW_ID

DAY, HOUR, MINUTE = 86_400, 3_600, 60
RUNS = 3
OWNERS = 40
#: Rows of a table in one task, where they are dealt: a part becomes several records.
DEALT_ROWS = {"repositories": 20_000, "pull_requests": 1_000_000, "issues": 500_000}
URL_PREFIX = "https://api.example.org/repos/"
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

_EPOCH_2020 = 1_577_836_800
_EPOCH_2026 = 1_767_225_600
_FIRST_EXTRACTION = 1_780_272_000  # 2026-06-01
_YEARS_AHEAD = 9_131 * DAY  # moves 1995-2001 into the date dimension's range
_LOAD_DELAY = 30 * MINUTE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, resource: str, count: int, by: str | Column) -> DataFrame:
    """``count`` rows over tasks of :data:`DEALT_ROWS`, by a value that is another one in each row."""
    tasks = -(-count // DEALT_ROWS[resource])
    return rows.repartition(tasks, by) if tasks > 1 else rows


def _envelope(
    df: DataFrame, resource: str, run: str, raw_id: str, payload: dict[str, str | dict[str, str]]
) -> DataFrame:
    """Envelopes with a column ``payload.<path>`` per payload leaf (a nested dict is a nested field).

    Flat leaves rather than one struct: Catalyst does not look into a struct
    that is costly to build, and would compute all of it for a single path.
    """
    extracted = f"{_FIRST_EXTRACTION}L + {run} * {DAY}"
    leaves = {}
    for name, value in payload.items():
        if isinstance(value, dict):
            leaves.update({f"{name}.{leaf}": text for leaf, text in value.items()})
        else:
            leaves[name] = value
    return df.selectExpr(
        f"'{resource}' AS _resource",
        f"concat('run-', {run}) AS _run_id",
        f"timestamp_seconds({extracted}) AS _extracted_at",
        f"concat_ws('-', '{resource}', {raw_id}) AS {RAW_ID}",
        f"timestamp_seconds({extracted} + {_LOAD_DELAY}) AS {LOADED_AT}",
        *[f"{text} AS `payload.{path}`" for path, text in leaves.items()],
        *_position(df),
    )


def _position(df: DataFrame) -> list[str]:
    """Where a row stands in its file, if a stream asks for it."""
    return [c for c in df.columns if c == "position"]


def nested(envelopes: DataFrame) -> DataFrame:
    """The same envelopes with the leaves gathered in one ``payload`` struct."""
    fields: dict[str, str | dict[str, str]] = {}
    for column in envelopes.columns:
        first, *path = column.split(".")
        if path:
            group = fields if len(path) == 1 else fields.setdefault(path[0], {})
            group[path[-1]] = f"`{column}`"
    parts = {name: value if isinstance(value, str) else _struct(value) for name, value in fields.items()}
    return envelopes.selectExpr(*[c for c in envelopes.columns if "." not in c], f"{_struct(parts)} AS payload")


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _full_name(key: str) -> str:
    return f"concat('owner', {key} % {OWNERS}, '/repo-', {key})"


def repositories(part: DataFrame) -> DataFrame:
    """Three daily listings; some repositories vanish, some vanish and return."""
    listed = (
        part.selectExpr("p_partkey AS k", "bigint(p_size) AS size", "p_name", "p_type", "p_brand", f"explode(sequence(1L, {RUNS}L)) AS r", *_position(part))
        .where("NOT (r = 3 AND k % 50 = 0) AND NOT (r = 2 AND k % 60 = 7)")
        .selectExpr(
            "*",
            f"k % {OWNERS} AS owner",
            "CASE WHEN k % 101 <> 0 THEN (k * 37) % 2500 + r * (k % 3) END AS stars",
            f"timestamp_seconds({_EPOCH_2020} + (k % 1500) * {DAY} + size * {HOUR}) AS created",
            f"timestamp_seconds({_EPOCH_2026} + r * {DAY} + size * {HOUR}) AS updated",
        )
    )
    payload = {
        "id": "k",
        "node_id": "concat('R_', k)",
        "name": "concat('repo-', k)",
        "full_name": _full_name("k"),
        "owner": {
            "login": "concat('owner', owner)",
            "id": "1000000 + owner",
            "type": "CASE WHEN owner % 5 = 0 THEN 'Organization' ELSE 'User' END",
        },
        "description": "concat('Repo ', p_name)",
        "homepage": "CASE WHEN size % 2 = 0 THEN concat('https://example.org/', k) END",
        "language": "CASE WHEN k % 17 <> 0 THEN p_type END",
        "topics": "split(p_name, ' ')",
        "visibility": "CASE WHEN k % 23 = 0 THEN 'internal' ELSE 'public' END",
        "default_branch": "'main'",
        "license": {
            "key": "CASE WHEN size % 4 <> 0 THEN lower(p_brand) END",
            "name": "CASE WHEN size % 4 <> 0 THEN p_brand END",
        },
        "fork": "CASE WHEN k % 43 <> 0 THEN k % 7 = 0 END",
        "archived": "k % 29 = 0",
        "disabled": "k % 31 = 0",
        "private": "false",
        "has_issues": "size % 2 = 0",
        "has_wiki": "size % 3 = 0",
        "has_discussions": "size % 5 = 0",
        "stargazers_count": "stars",
        "watchers_count": "stars",
        "forks_count": "(k * 13) % 400",
        "open_issues_count": "size",
        "size": "size * 100",
        "created_at": "created",
        "updated_at": "updated",
        "pushed_at": "updated",
    }
    return _envelope(listed, "repositories", "r", "r, k", payload)


def pull_requests(lineitem: DataFrame) -> DataFrame:
    """One listing; order lines share ids, so the same request can arrive more than once."""
    lines = (
        lineitem.selectExpr(
            "l_orderkey AS o",
            "bigint(l_linenumber) AS number",
            "l_partkey AS repo",
            "l_suppkey AS author",
            "l_returnflag",
            "l_linestatus",
            "l_tax",
            "unix_seconds(timestamp(l_shipdate)) AS shipped",
        )
        .selectExpr(
            "*",
            f"shipped + {_YEARS_AHEAD} + (author % 24) * {HOUR} + (o % 60) * {MINUTE} AS created",
            f"concat('{URL_PREFIX}', {_full_name('repo')}) AS url",
        )
        .selectExpr(
            "*",
            f"CASE WHEN l_linestatus = 'F' THEN timestamp_seconds(created + (o % 200) * {37 * MINUTE}) END AS closed",
        )
    )
    payload = {
        "id": "o * 8 + number",
        "number": "number",
        "node_id": "concat('PR_', o, '_', number)",
        "title": "CASE WHEN number = 7 AND o % 100 = 0 THEN '' ELSE concat('Change ', o) END",
        "user": {"login": "concat('dev', author)", "id": "2000000 + author", "type": "'User'"},
        "state": "CASE WHEN l_linestatus = 'F' THEN 'closed' ELSE 'open' END",
        "comments": "o % 11",
        "score": "l_tax",
        "created_at": "timestamp_seconds(created)",
        "updated_at": "coalesce(closed, timestamp_seconds(created))",
        "closed_at": "closed",
        "pull_request": {"merged_at": "CASE WHEN l_returnflag = 'N' THEN closed END"},
        # Some addresses differ in letter case only.
        "repository_url": "CASE WHEN repo % 10 = 0 THEN upper(url) ELSE url END",
    }
    raw_id = "o, number, repo, author, shipped, l_returnflag, l_linestatus, bigint(round(l_tax * 100))"
    return _envelope(lines, "pull_requests", f"{RUNS}L", raw_id, payload)


def issues(events: DataFrame) -> DataFrame:
    """One listing; a few authors are also repository owners, a few addresses are broken."""
    reports = (
        events.selectExpr(
            "event_id AS k",
            "user_id AS repo",
            "event_type",
            "value",
            "bigint(get_json_object(props, '$.k')) AS author",
            "timestamp(ts) AS created",
        )
        .selectExpr(
            "*",
            "CASE WHEN event_type IN ('purchase', 'signup') THEN "
            f"timestamp_micros(unix_micros(created) + (k % 500) * {11 * MINUTE * 1_000_000}) END AS closed",
        )
    )
    payload = {
        "id": "k",
        "number": "k % 1000",
        "node_id": "concat('I_', k)",
        "title": "concat_ws(' ', event_type, 'report', k)",
        "user": {
            "login": "CASE WHEN author >= 90 THEN concat('owner', author - 90) "
            "WHEN author % 10 = 0 THEN concat('Dev', author) ELSE concat('dev', author) END",
            "id": "CASE WHEN author >= 90 THEN 1000000 + author - 90 ELSE 2000000 + author END",
            "type": "'User'",
        },
        "state": "CASE WHEN closed IS NOT NULL THEN 'closed' ELSE 'open' END",
        "comments": "CASE WHEN event_type <> 'error' THEN k % 7 END",
        "score": "value",
        "created_at": "created",
        "updated_at": "coalesce(closed, created)",
        "closed_at": "closed",
        "repository_url": "CASE WHEN event_type = 'error' AND k % 50 = 0 THEN 'unknown' "
        f"ELSE concat('{URL_PREFIX}', {_full_name('repo')}) END",
    }
    return _envelope(reports, "issues", f"{RUNS}L", "k", payload)


FEEDS = {
    "repositories": ("part", repositories),
    "pull_requests": ("lineitem", pull_requests),
    "issues": ("events", issues),
}


def feed(spark: SparkSession, sf_dir: str, resource: str, sorts: bool = False) -> DataFrame:
    """``sorts`` says that the tasks that read it will sort whole records, which then should not be too many."""
    name, envelopes = FEEDS[resource]
    rows = table(spark, sf_dir, name)
    if sorts or resource == "repositories":
        count = rows.count()
        # Rows that are not dealt are read without their index.
        if count > DEALT_ROWS[resource]:
            placed = rows.select("*", F.col("_metadata.row_index").alias("__row"))
            rows = dealt(placed, resource, count, "__row").drop("__row")
    return envelopes(rows)


def feed_stream(spark: SparkSession, sf_dir: str, resource: str, max_files: int | None = None) -> DataFrame:
    """The same feed as a stream over the files of its table."""
    name, envelopes = FEEDS[resource]
    held = table(spark, sf_dir, name)
    reader = spark.readStream.schema(held.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A pattern, because the table may be one file or a folder of files.
    rows = reader.parquet(f"{sf_dir}/{name}.parque[t]")
    rows = rows.withColumn("position", F.struct("_metadata.file_path", "_metadata.row_index"))
    return envelopes(dealt(rows, resource, held.count(), "position"))


def payload_text(envelopes: DataFrame) -> DataFrame:
    """The same envelopes with the payload as the JSON text a feed would deliver."""
    options = {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_TEXT}
    return nested(envelopes).withColumn("payload", F.to_json("payload", options))
