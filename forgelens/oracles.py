"""The registered queries once more, as SQL over the benchmark tables.

Nothing here is generated from the Spark code: staging is written as column
expressions on the base tables, history as window functions, and so on.
"""

from __future__ import annotations

# ---------------------------------------------------------------- staged feeds

REPOS = """
runs AS (SELECT unnest([1, 2, 3])::BIGINT AS r),
repos AS (
  SELECT 'repositories-' || r || '-' || p_partkey AS airbyte_raw_id,
         TIMESTAMP '2026-06-01 00:30:00' + to_days(r::INT) AS airbyte_extracted_at,
         'run-' || r AS run_id,
         TIMESTAMP '2026-06-01' + to_days(r::INT) AS extracted_at,
         p_partkey AS repo_id,
         'R_' || p_partkey AS node_id,
         'repo-' || p_partkey AS repo_name,
         'owner' || (p_partkey % 40) || '/repo-' || p_partkey AS full_name,
         'owner' || (p_partkey % 40) AS owner_login,
         1000000 + p_partkey % 40 AS owner_id,
         CASE WHEN p_partkey % 40 % 5 = 0 THEN 'Organization' ELSE 'User' END AS owner_type,
         'Repo ' || p_name AS description,
         NULL::VARCHAR AS html_url,
         CASE WHEN p_size % 2 = 0 THEN 'https://example.org/' || p_partkey END AS homepage,
         CASE WHEN p_partkey % 17 <> 0 THEN p_type END AS language,
         string_split(p_name, ' ') AS topics,
         CASE WHEN p_partkey % 23 = 0 THEN 'internal' ELSE 'public' END AS visibility,
         'main' AS default_branch,
         CASE WHEN p_size % 4 <> 0 THEN lower(p_brand) END AS license_key,
         CASE WHEN p_size % 4 <> 0 THEN p_brand END AS license_name,
         CASE WHEN p_partkey % 43 <> 0 THEN p_partkey % 7 = 0 END AS is_fork,
         p_partkey % 29 = 0 AS is_archived,
         p_partkey % 31 = 0 AS is_disabled,
         FALSE AS is_private,
         p_size % 2 = 0 AS has_issues,
         p_size % 3 = 0 AS has_wiki,
         p_size % 5 = 0 AS has_discussions,
         NULL::BOOLEAN AS has_pages,
         CASE WHEN p_partkey % 101 <> 0 THEN p_partkey * 37 % 2500 + r * (p_partkey % 3) END AS stargazers_count,
         CASE WHEN p_partkey % 101 <> 0 THEN p_partkey * 37 % 2500 + r * (p_partkey % 3) END AS watchers_count,
         p_partkey * 13 % 400 AS forks_count,
         p_size::BIGINT AS open_issues_count,
         p_size::BIGINT * 100 AS size_kb,
         NULL::DOUBLE AS search_score,
         TIMESTAMP '2020-01-01' + to_days((p_partkey % 1500)::INT) + to_hours(p_size) AS created_at,
         TIMESTAMP '2026-01-01' + to_days(r::INT) + to_hours(p_size) AS updated_at,
         TIMESTAMP '2026-01-01' + to_days(r::INT) + to_hours(p_size) AS pushed_at
  FROM part, runs
  WHERE NOT (r = 3 AND p_partkey % 50 = 0) AND NOT (r = 2 AND p_partkey % 60 = 7)
)"""

PRS = """
pr_source AS (
  SELECT *, l_orderkey * 8 + l_linenumber AS id,
         l_shipdate + to_days(9131) + to_hours((l_suppkey % 24)::INT) + to_minutes((l_orderkey % 60)::INT) AS created,
         'https://api.example.org/repos/owner' || (l_partkey % 40) || '/repo-' || l_partkey AS url,
         'owner' || (l_partkey % 40) || '/repo-' || l_partkey AS slug
  FROM lineitem
),
prs AS (
  SELECT concat_ws('-', 'pull_requests', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   epoch(l_shipdate)::BIGINT, l_returnflag, l_linestatus, round(l_tax * 100)::BIGINT) AS airbyte_raw_id,
         TIMESTAMP '2026-06-04 00:30:00' AS airbyte_extracted_at,
         'run-3' AS run_id,
         TIMESTAMP '2026-06-04' AS extracted_at,
         id AS pr_id,
         l_linenumber::BIGINT AS pr_number,
         'PR_' || l_orderkey || '_' || l_linenumber AS node_id,
         CASE WHEN l_linenumber = 7 AND l_orderkey % 100 = 0 THEN '' ELSE 'Change ' || l_orderkey END AS title,
         CASE WHEN l_linestatus = 'F' THEN 'closed' ELSE 'open' END AS state,
         CASE WHEN l_partkey % 10 = 0 THEN upper(url) ELSE url END AS repository_url,
         'dev' || l_suppkey AS author_login,
         2000000 + l_suppkey AS author_id,
         l_orderkey % 11 AS comments_count,
         l_tax AS search_score,
         created AS created_at,
         CASE WHEN l_linestatus = 'F' THEN created + to_minutes((l_orderkey % 200 * 37)::INT) ELSE created END AS updated_at,
         CASE WHEN l_linestatus = 'F' THEN created + to_minutes((l_orderkey % 200 * 37)::INT) END AS closed_at,
         CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N'
              THEN created + to_minutes((l_orderkey % 200 * 37)::INT) END AS merged_at,
         CASE WHEN l_partkey % 10 = 0 THEN upper(slug) ELSE slug END AS repo_full_name,
         l_linestatus = 'F' AND l_returnflag = 'N' AS is_merged
  FROM pr_source
)"""

ISSUES = """
issue_source AS (
  SELECT *, (props ->> '$.k')::BIGINT AS k, event_type IN ('purchase', 'signup') AS done,
         ts + to_minutes((event_id % 500 * 11)::INT) AS ended,
         'owner' || (user_id % 40) || '/repo-' || user_id AS slug,
         event_type = 'error' AND event_id % 50 = 0 AS broken
  FROM events
),
issues AS (
  SELECT 'issues-' || event_id AS airbyte_raw_id,
         TIMESTAMP '2026-06-04 00:30:00' AS airbyte_extracted_at,
         'run-3' AS run_id,
         TIMESTAMP '2026-06-04' AS extracted_at,
         event_id AS issue_id,
         event_id % 1000 AS issue_number,
         'I_' || event_id AS node_id,
         event_type || ' report ' || event_id AS title,
         CASE WHEN done THEN 'closed' ELSE 'open' END AS state,
         CASE WHEN broken THEN 'unknown' ELSE 'https://api.example.org/repos/' || slug END AS repository_url,
         CASE WHEN k >= 90 THEN 'owner' || (k - 90) WHEN k % 10 = 0 THEN 'Dev' || k ELSE 'dev' || k END AS author_login,
         CASE WHEN k >= 90 THEN 1000000 + k - 90 ELSE 2000000 + k END AS author_id,
         CASE WHEN event_type <> 'error' THEN event_id % 7 END AS comments_count,
         value AS search_score,
         ts AS created_at,
         CASE WHEN done THEN ended ELSE ts END AS updated_at,
         CASE WHEN done THEN ended END AS closed_at,
         CASE WHEN NOT broken THEN slug END AS repo_full_name
  FROM issue_source
)"""

# ------------------------------------------------------------------- history

WATCHED = (
    "stargazers_count, forks_count, open_issues_count, language, description, topics, "
    "is_archived, is_disabled, has_issues, has_wiki, has_discussions"
)


def _history(rows: str) -> str:
    """Versions of all rows so far: a version ends when a later row of its repository differs."""
    return f"""
neighbours AS (
  SELECT *, row_number() OVER w = 1 AS is_first, ({WATCHED}) IS DISTINCT FROM lag(({WATCHED})) OVER w AS moved
  FROM {rows} WINDOW w AS (PARTITION BY repo_id ORDER BY extracted_at, run_id)
),
history AS (
  SELECT * EXCLUDE (is_first, moved), md5(concat_ws('|', repo_id, epoch_us(updated_at), run_id)) AS dbt_scd_id,
         updated_at AS dbt_updated_at, updated_at AS dbt_valid_from,
         lead(updated_at) OVER (PARTITION BY repo_id ORDER BY extracted_at, run_id) AS dbt_valid_to
  FROM neighbours WHERE is_first OR moved
),
live AS (SELECT * FROM history WHERE dbt_valid_to IS NULL)"""


HISTORY = REPOS + "," + _history("repos")

# The same where every run lists all repositories: one that is not listed is closed at that run.
COMPLETE_HISTORY = (
    REPOS
    + """,
run_no AS (SELECT run_id, extracted_at AS run_ts, row_number() OVER (ORDER BY extracted_at) AS n
           FROM (SELECT DISTINCT run_id, extracted_at FROM repos)),
seen AS (SELECT repos.*, n FROM repos JOIN run_no USING (run_id)),
neighbours AS (
  SELECT *, lag(n) OVER w AS n_before, lead(n) OVER w AS n_after,
         (stargazers_count, forks_count, open_issues_count, language, description, topics,
          is_archived, is_disabled, has_issues, has_wiki, has_discussions)
         IS DISTINCT FROM
         lag((stargazers_count, forks_count, open_issues_count, language, description, topics,
              is_archived, is_disabled, has_issues, has_wiki, has_discussions)) OVER w AS moved
  FROM seen WINDOW w AS (PARTITION BY repo_id ORDER BY n)
),
marked AS (
  SELECT *, sum(CASE WHEN n_before IS NULL OR n_before < n - 1 OR moved THEN 1 ELSE 0 END)
            OVER (PARTITION BY repo_id ORDER BY n) AS version_no
  FROM neighbours
),
spans AS (SELECT repo_id, version_no, min(n) AS n_from, max(n) AS n_to FROM marked GROUP BY ALL),
ends AS (
  SELECT s.repo_id, s.version_no, s.n_from,
         CASE WHEN nxt.updated_at IS NOT NULL THEN nxt.updated_at ELSE run_no.run_ts END AS ended
  FROM spans s
  LEFT JOIN marked nxt ON nxt.repo_id = s.repo_id AND nxt.n = s.n_to + 1
  LEFT JOIN run_no ON run_no.n = s.n_to + 1
),
history AS (
  SELECT m.* EXCLUDE (n, n_before, n_after, moved, version_no),
         md5(concat_ws('|', m.repo_id, epoch_us(m.updated_at), m.run_id)) AS dbt_scd_id,
         m.updated_at AS dbt_updated_at,
         m.updated_at AS dbt_valid_from,
         e.ended AS dbt_valid_to
  FROM marked m JOIN ends e ON e.repo_id = m.repo_id AND e.n_from = m.n
),
live AS (SELECT * FROM history WHERE dbt_valid_to IS NULL)"""
)


def _key(*columns: str) -> str:
    parts = ", ".join(f"coalesce({c}::VARCHAR, '_dbt_utils_surrogate_key_null_')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


TIE = "airbyte_extracted_at DESC NULLS LAST, airbyte_raw_id DESC NULLS LAST"

DIM_REPOS_COLUMNS = (
    "repo_id, node_id, full_name, repo_name, owner_login, owner_id, owner_type, language, description, homepage, "
    "array_to_string(topics, ',') AS topics, visibility, default_branch, license_key, license_name, is_fork, "
    "is_archived, is_disabled, is_private, has_issues, has_wiki, has_discussions, has_pages, created_at, updated_at, pushed_at"
)

FACT_REPOS = f"""
fact_repos AS (
  SELECT {_key('repo_id', 'run_id')} AS snapshot_id, {_key('repo_id')} AS repo_key, {_key('owner_id')} AS developer_key,
         extracted_at::DATE AS date_key, repo_id, run_id, full_name, owner_id, extracted_at,
         extracted_at::DATE AS snapshot_date, stargazers_count, watchers_count, forks_count, open_issues_count,
         size_kb, search_score
  FROM repos
  QUALIFY row_number() OVER (PARTITION BY repo_id, run_id ORDER BY extracted_at DESC NULLS FIRST, {TIE}) = 1
)"""

FACT_PRS = f"""
fact_prs AS (
  SELECT {_key('pr_id', 'run_id')} AS pr_snapshot_id, {_key('author_id')} AS developer_key, created_at::DATE AS date_key,
         pr_id, pr_number, node_id, run_id, repo_full_name, author_login, author_id, title, state, is_merged,
         comments_count, search_score, created_at, created_at::DATE AS created_date, updated_at, closed_at,
         closed_at::DATE AS closed_date, merged_at, merged_at::DATE AS merged_date,
         date_diff('hour', created_at, closed_at) AS hours_to_close
  FROM prs
  QUALIFY row_number() OVER (PARTITION BY pr_id, run_id ORDER BY created_at DESC NULLS FIRST, {TIE}) = 1
)"""

FACT_ISSUES = f"""
fact_issues AS (
  SELECT {_key('issue_id', 'run_id')} AS issue_snapshot_id, {_key('author_id')} AS developer_key,
         created_at::DATE AS date_key, issue_id, issue_number, node_id, run_id, repo_full_name, author_login,
         author_id, title, state, comments_count, search_score, created_at, created_at::DATE AS created_date,
         updated_at, closed_at, closed_at::DATE AS closed_date,
         date_diff('hour', created_at, closed_at) AS hours_to_close
  FROM issues
  QUALIFY row_number() OVER (PARTITION BY issue_id, run_id ORDER BY created_at DESC NULLS FIRST, {TIE}) = 1
)"""

DIM_DATE = """
calendar AS (
  SELECT d::DATE AS date_id, d::DATE AS date_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
         strftime(d, '%b') AS month_name, weekofyear(d) AS week_of_year, dayofyear(d) AS day_of_year,
         dayofweek(d) AS day_of_week, strftime(d, '%a') AS day_name, date_trunc('week', d)::DATE AS week_start_date,
         date_trunc('month', d)::DATE AS month_start_date, date_trunc('quarter', d)::DATE AS quarter_start_date,
         date_trunc('year', d)::DATE AS year_start_date, dayofweek(d) NOT IN (0, 6) AS is_weekday
  FROM generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY) AS g(d)
)"""

DEVELOPERS = f"""
developers AS (
  SELECT {_key('developer_id')} AS developer_key, developer_id, developer_login, developer_type
  FROM (SELECT owner_id AS developer_id, owner_login AS developer_login, owner_type AS developer_type FROM repos
        UNION SELECT author_id, author_login, 'User' FROM prs
        UNION SELECT author_id, author_login, 'User' FROM issues)
  WHERE developer_id IS NOT NULL
)"""

TIER = """CASE WHEN stargazers_count >= 1000 THEN 'high' WHEN stargazers_count >= 100 THEN 'medium'
              WHEN stargazers_count >= 10 THEN 'low' ELSE 'minimal' END"""

TRENDING = f"""
trending AS (
  SELECT repo_id, full_name, repo_name, owner_login, language, description, homepage,
         array_to_string(topics, ',') AS topics, visibility, license_key, default_branch, stargazers_count,
         watchers_count, forks_count, open_issues_count, size_kb, is_fork, is_archived, has_issues, has_wiki,
         has_discussions, created_at, updated_at, pushed_at, date_trunc('day', created_at)::TIMESTAMP AS created_date,
         date_trunc('week', created_at)::TIMESTAMP AS created_week,
         date_diff('day', created_at, updated_at) AS days_since_creation, {TIER} AS star_tier
  FROM live WHERE NOT is_archived AND NOT is_disabled
)"""

ACTIVITY = """
language_votes AS (
  SELECT owner_login, owner_id, owner_type, language
  FROM live WHERE owner_login IS NOT NULL AND language IS NOT NULL
  GROUP BY owner_login, owner_id, owner_type, language
  QUALIFY row_number() OVER (PARTITION BY owner_login, owner_id, owner_type ORDER BY count(*) DESC, language) = 1
),
activity AS (
  SELECT l.owner_login, l.owner_id, l.owner_type,
         count(*) AS repos_created,
         count(*) FILTER (WHERE NOT is_fork) AS original_repos,
         count(*) FILTER (WHERE is_fork) AS forked_repos,
         sum(stargazers_count)::BIGINT AS total_stars,
         sum(forks_count)::BIGINT AS total_forks,
         sum(open_issues_count)::BIGINT AS total_open_issues,
         avg(stargazers_count) AS avg_stars_per_repo,
         count(DISTINCT l.language) AS distinct_languages,
         array_to_string(coalesce(list(DISTINCT l.language ORDER BY l.language)
                                  FILTER (WHERE l.language IS NOT NULL), []), ',') AS languages_used,
         any_value(v.language) AS primary_language,
         min(created_at) AS first_repo_at,
         max(created_at) AS latest_repo_at,
         date_diff('day', min(created_at), max(created_at)) AS active_days_span
  FROM live l LEFT JOIN language_votes v
    ON v.owner_login = l.owner_login AND v.owner_id = l.owner_id AND v.owner_type = l.owner_type
  WHERE l.owner_login IS NOT NULL
  GROUP BY l.owner_login, l.owner_id, l.owner_type
)"""


def _percent(part: str, whole: str) -> str:
    """A decimal quotient of six digits, in percent with one digit; halves go up, all in whole numbers."""
    quotient = f"((2 * 1000000 * {part} + {whole}) // (2 * {whole}))"
    return f"(({quotient} + 500) // 1000)::DOUBLE / 10"


def _health(name: str, issues: str = "issues", prs: str = "prs") -> str:
    return f"""
{name} AS (
  SELECT r.repo_id, r.full_name, r.owner_login, r.language, r.stargazers_count, r.forks_count, r.open_issues_count,
         r.has_issues, r.has_wiki, r.has_discussions, r.license_key, r.created_at,
         coalesce(i.n, 0) AS tracked_issues, coalesce(i.n_open, 0) AS tracked_open_issues,
         coalesce(i.n_closed, 0) AS tracked_closed_issues, coalesce(i.comments, 0) AS avg_issue_comments,
         coalesce(p.n, 0) AS tracked_prs, coalesce(p.n_merged, 0) AS merged_prs, coalesce(p.n_open, 0) AS open_prs,
         coalesce(p.comments, 0) AS avg_pr_comments,
         {_percent("i.n_closed", "i.n")} AS issue_close_rate_pct,
         {_percent("p.n_merged", "p.n")} AS pr_merge_rate_pct,
         least(100, 10 * (has_issues::INT + has_wiki::INT + has_discussions::INT)
                    + 20 * (license_key IS NOT NULL)::INT + 10 * coalesce(stargazers_count > 0, FALSE)::INT
                    + 20 * (i.n IS NOT NULL)::INT + 20 * (p.n IS NOT NULL)::INT) AS health_score
  FROM live r
  LEFT JOIN (SELECT lower(repo_full_name) AS k, count(*) AS n, count(*) FILTER (WHERE state = 'open') AS n_open,
                    count(*) FILTER (WHERE state = 'closed') AS n_closed, avg(comments_count) AS comments
             FROM {issues} GROUP BY 1) i ON i.k = lower(r.full_name)
  LEFT JOIN (SELECT lower(repo_full_name) AS k, count(*) AS n, count(*) FILTER (WHERE is_merged) AS n_merged,
                    count(*) FILTER (WHERE state = 'open') AS n_open, avg(comments_count) AS comments
             FROM {prs} GROUP BY 1) p ON p.k = lower(r.full_name)
)"""


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _iso(*columns: str) -> str:
    return "REPLACE (" + ", ".join(f"{c}::VARCHAR AS {c}" for c in columns) + ")"


STREAMED = """
streamed AS (SELECT *, coalesce(stargazers_count, 0) AS stars, extracted_at AS event_time FROM repos),
last_repo AS (SELECT * FROM streamed QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY event_time DESC) = 1)"""
TIER_OF_STREAM = TIER.replace("stargazers_count", "stars")
OWNER_TOTALS = """
            SELECT owner_login, count(*) AS repos_count, sum(stars)::BIGINT AS total_stars,
                   sum(forks_count)::BIGINT AS total_forks FROM last_repo GROUP BY 1"""
OWNER_WINDOWS = """
            SELECT date_trunc('day', event_time)::TIMESTAMP AS window_start,
                   date_trunc('day', event_time)::TIMESTAMP + to_days(1) AS window_end, owner_login,
                   count(*) AS repos_count, sum(stars)::BIGINT AS total_stars, sum(forks_count)::BIGINT AS total_forks
            FROM streamed GROUP BY ALL"""

DIM_REPOS = f"""
dim_repos AS (SELECT {_key('repo_id')} AS repo_key, {DIM_REPOS_COLUMNS} FROM live)"""


# ------------------------------------------------------------------ rule counts
# (table, rule, column, severity, what violates it); the SQL behind "unique" and
# "relationships" is in _rules.  Names on the left are those of the stored tables.

SQL_NAMES = {
    "repositories": "repos",
    "pull_requests": "prs",
    "stg_repositories": "repos",
    "stg_pull_requests": "prs",
    "stg_issues": "issues",
    "repos_snapshot": "history",
    "dim_developers": "developers",
    "dim_date": "calendar",
    "fact_repo_snapshots": "fact_repos",
    "fact_pull_requests": "fact_prs",
    "mart_trending_repos": "trending",
    "mart_developer_activity": "activity",
    "mart_community_health": "health",
}


def _nulls(table: str, columns: str) -> list[tuple]:
    return [(table, "not_null", c, "error", f"{c} IS NULL") for c in columns.split()]


def _uniques(table: str, columns: str) -> list[tuple]:
    return [(table, "unique", c, "error", None) for c in columns.split()]


def _at_least(table: str, columns: str, floor: int = 0) -> list[tuple]:
    return [(table, f"is_true(>= {floor})", c, "error", f"{c} < {floor}") for c in columns.split()]


def _written_checks(table: str, key: str) -> list[tuple]:
    return [
        *_nulls(table, f"airbyte_raw_id {key} state author_login"),
        (table, "accepted_values", "state", "error", "state <> 'open' AND state <> 'closed'"),
        (table, "length_between", "title", "warn", "length(title) = 0 OR length(title) > 500"),
        *_at_least(table, "comments_count"),
    ]


def _fact_checks(table: str, key: str) -> list[tuple]:
    return [
        *_nulls(table, f"{key} developer_key date_key"),
        *_uniques(table, key),
        (table, "relationships", "developer_key", "error", "developers.developer_key"),
        (table, "relationships", "date_key", "error", "calendar.date_id"),
        (table, "accepted_values", "state", "error", "state <> 'open' AND state <> 'closed'"),
        (table, "is_true(>= 0)", "hours_to_close", "error", "hours_to_close < 0", "hours_to_close IS NOT NULL"),
    ]


def _not_empty(table: str) -> tuple:
    return (table, "row_count_between", "*", "error", None)


def _casts(table: str, columns: str) -> list[tuple]:
    """Only the comments of issues hold words, where they are 0 in the feed."""
    word = {"comments_count": "comments_count = 0"} if table == "stg_issues" else {}
    return [(table, "fits_type", c, "error", word.get(c, "false")) for c in columns.split()]


TABLE_CHECKS = [
    *_casts("stg_repositories", """repo_id owner_id is_fork is_archived is_disabled is_private has_issues has_wiki
        has_discussions has_pages stargazers_count watchers_count forks_count open_issues_count size_kb search_score
        created_at updated_at pushed_at"""),
    *_casts("stg_pull_requests", """pr_id pr_number author_id comments_count search_score created_at updated_at
        closed_at merged_at"""),
    *_casts("stg_issues", "issue_id issue_number author_id comments_count search_score created_at updated_at closed_at"),
    _not_empty("stg_repositories"),
    *_nulls("stg_repositories", "airbyte_raw_id repo_id full_name owner_login stargazers_count"),
    ("stg_repositories", "accepted_values", "visibility", "error",
     "visibility <> 'public' AND visibility <> 'private' AND visibility <> 'internal'"),
    ("stg_repositories", "between", "stargazers_count", "warn", "stargazers_count < 5"),
    *_at_least("stg_repositories", "stargazers_count forks_count"),
    *_written_checks("stg_pull_requests", "pr_id"),
    *_written_checks("stg_issues", "issue_id"),
    *_nulls("repos_snapshot", "repo_id full_name dbt_valid_from dbt_scd_id"),
    *_uniques("repos_snapshot", "dbt_scd_id"),
    *_at_least("repos_snapshot", "stargazers_count forks_count"),
    ("repos_snapshot", "is_true(> dbt_valid_from)", "dbt_valid_to", "warn", "dbt_valid_to <= dbt_valid_from"),
    *_nulls("dim_repos", "repo_key repo_id full_name owner_login"),
    *_uniques("dim_repos", "repo_key repo_id full_name"),
    *_nulls("dim_developers", "developer_key developer_id developer_login"),
    *_uniques("dim_developers", "developer_key developer_id"),
    *_nulls("dim_date", "date_id"),
    *_uniques("dim_date", "date_id"),
    *_at_least("dim_date", "year", 2020),
    *_nulls("fact_repo_snapshots", "snapshot_id repo_key developer_key date_key"),
    *_uniques("fact_repo_snapshots", "snapshot_id"),
    ("fact_repo_snapshots", "relationships", "repo_key", "error", "dim_repos.repo_key"),
    ("fact_repo_snapshots", "relationships", "developer_key", "error", "developers.developer_key"),
    ("fact_repo_snapshots", "relationships", "date_key", "error", "calendar.date_id"),
    *_at_least("fact_repo_snapshots", "stargazers_count forks_count"),
    *_fact_checks("fact_pull_requests", "pr_snapshot_id"),
    *_fact_checks("fact_issues", "issue_snapshot_id"),
    _not_empty("mart_trending_repos"),
    *_nulls("mart_trending_repos", "repo_id full_name stargazers_count forks_count star_tier"),
    *_uniques("mart_trending_repos", "repo_id"),
    *_at_least("mart_trending_repos", "stargazers_count forks_count"),
    ("mart_trending_repos", "accepted_values", "star_tier", "error",
     "NOT list_contains(['high', 'medium', 'low', 'minimal'], star_tier)"),
    _not_empty("mart_developer_activity"),
    *_nulls("mart_developer_activity", "owner_login repos_created"),
    *_uniques("mart_developer_activity", "owner_login"),
    *_at_least("mart_developer_activity", "repos_created", 1),
    *_at_least("mart_developer_activity", "total_stars avg_stars_per_repo"),
    _not_empty("mart_community_health"),
    *_nulls("mart_community_health", "repo_id full_name health_score"),
    *_uniques("mart_community_health", "repo_id"),
    ("mart_community_health", "between", "health_score", "error", "health_score < 0 OR health_score > 100"),
    *_at_least("mart_community_health", "tracked_issues tracked_prs"),
    ("mart_community_health", "between", "pr_merge_rate_pct", "warn", "pr_merge_rate_pct < 0 OR pr_merge_rate_pct > 100"),
]

SOURCE_CHECKS = [
    *[("repositories", "column_exists", c, "error", None) for c in ("id", "full_name", "stargazers_count")],
    ("repositories", "not_null", "id", "error", "repo_id IS NULL"),
    ("repositories", "not_null", "full_name", "error", "full_name IS NULL"),
    ("repositories", "between", "stargazers_count", "error", "stargazers_count < 5"),
    ("repositories", "accepted_values", "language", "error", "language <> 'Python'"),
    _not_empty("repositories"),
    *[check for table, key in (("pull_requests", "pr_id"), ("issues", "issue_id")) for check in (
        (table, "column_exists", "id", "error", None),
        (table, "not_null", "id", "error", f"{key} IS NULL"),
        (table, "not_null", "title", "error", "title IS NULL"),
        (table, "accepted_values", "state", "error", "state <> 'open' AND state <> 'closed'"),
    )],
    ("issues", "between", "comments", "error", "comments_count < 0"),
]


def _rules(checks: list[tuple]) -> str:
    """One SELECT per rule: how many rows it looked at and how many break it."""
    selects = []
    for table, rule, column, severity, violation, *where in checks:
        source = SQL_NAMES.get(table, table)
        if rule == "unique":
            counted = f"""SELECT (SELECT count(*) FROM {source}) AS n_checked, (SELECT count(*) FROM
                (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS n_failed"""
        elif rule == "relationships":
            parent, parent_column = violation.split(".")
            counted = f"""SELECT count(*) AS n_checked, count(*) FILTER (WHERE {column} IS NOT NULL AND {column} NOT IN
                (SELECT {parent_column} FROM {parent} WHERE {parent_column} IS NOT NULL)) AS n_failed FROM {source}"""
        elif rule == "row_count_between":
            counted = f"SELECT count(*) AS n_checked, (count(*) = 0)::BIGINT AS n_failed FROM {source}"
        elif rule == "column_exists":
            counted = "SELECT 1 AS n_checked, 0 AS n_failed"
        else:
            kept = f"WHERE {where[0]}" if where else ""
            counted = f"SELECT count(*) AS n_checked, count(*) FILTER (WHERE {violation}) AS n_failed FROM {source} {kept}"
        selects.append(
            f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, '{severity}' AS severity, "
            f"n_checked::BIGINT AS n_checked, n_failed::BIGINT AS n_failed, n_failed = 0 AS passed FROM ({counted})"
        )
    return "\nUNION ALL\n".join(selects)


HISTORY_OUT = "SELECT * REPLACE (array_to_string(topics, ',') AS topics) FROM "


def oracle_sql() -> dict[str, str]:
    calendar_dates = ("date_id", "date_day", "week_start_date", "month_start_date", "quarter_start_date", "year_start_date")
    sql = {
        "stg_repositories": _with([REPOS], HISTORY_OUT + "repos"),
        "stg_pull_requests": _with([PRS], "SELECT * FROM prs"),
        "stg_issues": _with([ISSUES], "SELECT * FROM issues"),
        "daily_partitions": _with([REPOS], """
            SELECT d.day::DATE::VARCHAR AS date, coalesce(string_agg(DISTINCT r.run_id, ','), '') AS runs,
                   count(r.run_id) AS records
            FROM (SELECT unnest(generate_series(DATE '2026-05-17', DATE '2026-06-05', INTERVAL 1 DAY)) AS day) d
            LEFT JOIN repos r ON r.extracted_at::DATE = d.day GROUP BY 1"""),
        "incremental_build": _with([REPOS, FACT_REPOS], f"SELECT * {_iso('date_key', 'snapshot_date')} FROM fact_repos"),
        "fact_repo_snapshots": _with([REPOS, FACT_REPOS], f"SELECT * {_iso('date_key', 'snapshot_date')} FROM fact_repos"),
        "fact_pull_requests": _with(
            [PRS, FACT_PRS], f"SELECT * {_iso('date_key', 'created_date', 'closed_date', 'merged_date')} FROM fact_prs"
        ),
        "fact_issues": _with([ISSUES, FACT_ISSUES], f"SELECT * {_iso('date_key', 'created_date', 'closed_date')} FROM fact_issues"),
        "lineitem_latest": """
            SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC NULLS FIRST, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1""",
        "latest_repos": _with([REPOS], f"""SELECT * REPLACE (array_to_string(topics, ',') AS topics) FROM repos
            QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY extracted_at DESC NULLS FIRST, {TIE}) = 1"""),
        "dim_developers": _with([REPOS, PRS, ISSUES, DEVELOPERS], "SELECT * FROM developers"),
        "repos_snapshot": _with([HISTORY], HISTORY_OUT + "history"),
        "repos_snapshot_by_run": _with([COMPLETE_HISTORY], HISTORY_OUT + "history"),
        "repos_snapshot_complete": _with([COMPLETE_HISTORY], HISTORY_OUT + "history"),
        "repos_snapshot_daily": _with([HISTORY], HISTORY_OUT + "history"),
        "repos_snapshot_daily_rebuilt": _with([HISTORY], HISTORY_OUT + "history"),
        "dim_repos": _with([HISTORY], f"SELECT {_key('repo_id')} AS repo_key, {DIM_REPOS_COLUMNS} FROM live"),
        "repos_as_of": _with([HISTORY], f"""SELECT {_key('repo_id')} AS repo_key, {DIM_REPOS_COLUMNS} FROM history
            WHERE dbt_valid_from <= TIMESTAMP '2026-01-04' AND (dbt_valid_to IS NULL OR dbt_valid_to > TIMESTAMP '2026-01-04')"""),
        "version_at_update": _with([HISTORY], """
            SELECT q.repo_id, q.run_id, q.asked_at, h.dbt_valid_from, h.dbt_valid_to, h.dbt_scd_id,
                   h.stargazers_count AS valid_stars
            FROM (SELECT repo_id, run_id, updated_at - to_hours((repo_id % 48)::INT) AS asked_at FROM repos) q
            LEFT JOIN history h ON h.repo_id = q.repo_id AND h.dbt_valid_from <= q.asked_at
              AND (h.dbt_valid_to IS NULL OR q.asked_at < h.dbt_valid_to)"""),
        "mart_trending_repos": _with([HISTORY, TRENDING], "SELECT * FROM trending"),
        "trending_by_tier": _with([HISTORY, TRENDING], """
            SELECT star_tier, count(*) AS repos, avg(stargazers_count) AS avg_stars FROM trending GROUP BY 1"""),
        "mart_developer_activity": _with([HISTORY, ACTIVITY], "SELECT * FROM activity"),
        "top_developers": _with([HISTORY, ACTIVITY], """
            SELECT owner_login, sum(repos_created)::BIGINT AS repos, sum(total_stars)::BIGINT AS stars
            FROM activity GROUP BY 1 ORDER BY stars DESC NULLS LAST, owner_login LIMIT 10"""),
        "mart_community_health": _with([HISTORY, PRS, ISSUES, _health("health")], "SELECT * FROM health"),
        "community_health_dedup": _with([HISTORY, PRS, ISSUES, f"""
            one_pr AS (SELECT * FROM prs QUALIFY row_number() OVER
              (PARTITION BY pr_id ORDER BY extracted_at DESC NULLS FIRST, {TIE}) = 1)""",
            _health("health", prs="one_pr")], "SELECT * FROM health"),
        "repo_metrics_over_time": _with([HISTORY, FACT_REPOS, DIM_DATE], """
            SELECT f.date_key::VARCHAR AS date_key, c.year, c.week_of_year, c.day_name, c.is_weekday, h.language,
                   count(*) AS repos, sum(f.stargazers_count)::BIGINT AS stars, sum(f.forks_count)::BIGINT AS forks,
                   sum(f.open_issues_count)::BIGINT AS open_issues
            FROM fact_repos f
            LEFT JOIN history h ON h.repo_id = f.repo_id AND h.dbt_valid_from <= f.extracted_at
                                   AND (h.dbt_valid_to IS NULL OR f.extracted_at < h.dbt_valid_to)
            LEFT JOIN calendar c ON c.date_id = f.date_key
            GROUP BY ALL"""),
        "pull_requests_by_day": _with([PRS, FACT_PRS, DIM_DATE], f"""
            SELECT c.* REPLACE (coalesce(c.date_id, f.date_key)::VARCHAR AS date_id, {_iso(*calendar_dates[1:])[9:-1]}),
                   count(f.pr_id) AS opened,
                   count(*) FILTER (WHERE f.is_merged) AS merged, count(f.hours_to_close) AS closed,
                   avg(f.hours_to_close) AS avg_hours_to_close
            FROM calendar c FULL JOIN fact_prs f ON f.date_key = c.date_id GROUP BY ALL"""),
        "pull_requests_by_owner": _with([HISTORY, PRS, FACT_PRS], """
            SELECT l.name IS NOT NULL AS is_listed, l.owner_type, l.language, count(DISTINCT lower(f.repo_full_name)) AS repos,
                   count(*) AS prs, count(*) FILTER (WHERE f.is_merged) AS merged
            FROM fact_prs f LEFT JOIN (
              SELECT lower(full_name) AS name, owner_type, language FROM live
              QUALIFY row_number() OVER (PARTITION BY lower(full_name) ORDER BY updated_at DESC, repo_id DESC) = 1
            ) l ON l.name = lower(f.repo_full_name) GROUP BY ALL"""),
        "search_repositories": _with([REPOS], """
            SELECT * REPLACE (array_to_string(topics, ',') AS topics) FROM repos
            WHERE created_at::DATE BETWEEN DATE '2020-02-01' AND DATE '2021-06-30'
              AND language = 'PROMO' AND stargazers_count >= 5"""),
        "page_dedup": """
            SELECT user_id AS id, event_id // 100 AS page, event_id % 100 AS position, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id // 100, event_id % 100) = 1""",
        "event_json_classify": """
            SELECT event_type, CASE WHEN k * 15 >= 1000 THEN 'high' WHEN k * 15 >= 100 THEN 'medium'
                                    WHEN k * 15 >= 10 THEN 'low' ELSE 'minimal' END AS star_tier,
                   count(*) AS n, sum(k)::BIGINT AS sum_k, 0::BIGINT AS sum_absent
            FROM (SELECT event_type, (props ->> '$.k')::BIGINT AS k FROM events) GROUP BY 1, 2""",
        "landing_roundtrip": _with([REPOS], """
            SELECT * EXCLUDE (airbyte_raw_id) REPLACE (array_to_string(topics, ',') AS topics,
                   TIMESTAMP '2026-06-05' AS airbyte_extracted_at) FROM repos"""),
        "run_manifest": _with([REPOS], """
            SELECT 'repositories' AS resource, run_id, extracted_at::DATE::VARCHAR AS date, count(*) AS records,
                   min(extracted_at) AS started_at_utc, max(extracted_at) AS finished_at_utc
            FROM repos GROUP BY ALL"""),
        "landed_day": _with([REPOS, """
            firsts AS (SELECT * FROM repos QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY run_id) = 1)"""], """
            SELECT 'day-1' AS run_id, count(*) AS repos, count(DISTINCT repo_id) AS ids, sum(stargazers_count)::BIGINT AS stars,
                   max(updated_at) AS last_update, 'repositories' AS resources, count(*) AS records,
                   TIMESTAMP '2026-06-02 06:00:00' AS started_at_utc, TIMESTAMP '2026-06-02 06:00:00' AS finished_at_utc,
                   '2026-06-02' AS date, TRUE AS has_files
            FROM firsts"""),
        "emptied_day": _with([REPOS], """
            SELECT 'repositories' AS resource, run_id, '2026-06-02' AS date, n AS records,
                   TIMESTAMP '2026-06-02 06:00:00' AS started_at_utc, n AS loaded
            FROM (SELECT 'day-1' AS run_id, count(DISTINCT repo_id) AS n FROM repos
                  UNION ALL SELECT 'day-1-again', 0)"""),
        "run_scoped_manifest": """
            SELECT 'issues' AS resource, 'run-3' AS run_id, '2026-06-04' AS date, count(*) AS records,
                   TIMESTAMP '2026-06-04' AS started_at_utc, TIMESTAMP '2026-06-04' AS finished_at_utc FROM events""",
        "stream_trending": _with([REPOS, STREAMED], f"""
            SELECT repo_id, full_name, coalesce(owner_login, '') AS owner_login, coalesce(language, '') AS language,
                   stars AS stargazers_count, forks_count, open_issues_count, {TIER_OF_STREAM} AS star_tier,
                   date_trunc('second', event_time) AS event_time FROM last_repo"""),
        "stream_trending_by_tier": _with([REPOS, STREAMED], f"""
            SELECT {TIER_OF_STREAM} AS star_tier, count(*) AS repos, avg(stars) AS avg_stars FROM last_repo GROUP BY 1"""),
        "stream_developer_latest": _with([REPOS, STREAMED], """
            SELECT owner_login, owner_type, 1::BIGINT AS repos_count, stars AS total_stars, forks_count AS total_forks,
                   coalesce(language, '') AS primary_language, date_trunc('second', event_time) AS event_time
            FROM streamed QUALIFY row_number() OVER (PARTITION BY owner_login ORDER BY event_time DESC, repo_id DESC) = 1"""),
        "stream_developer_totals": _with([REPOS, STREAMED], OWNER_TOTALS),
        "stream_top_developers": _with([REPOS, STREAMED], """
            SELECT owner_login, count(*) AS repos, sum(stars)::BIGINT AS stars FROM last_repo
            GROUP BY 1 ORDER BY stars DESC, owner_login LIMIT 10"""),
        "stream_owner_windows": _with([REPOS, STREAMED], OWNER_WINDOWS),
        "stream_closed_windows": _with([REPOS, STREAMED], OWNER_WINDOWS),
        "stream_resumed": _with([REPOS, STREAMED], """
            SELECT owner_login, count(*) AS deliveries, sum(stars)::BIGINT AS stars FROM streamed GROUP BY 1"""),
        "stream_owner_changes": _with([REPOS, STREAMED], OWNER_TOTALS),
        "stream_dead_letters": """
            SELECT missing, count(*) AS messages FROM (
              SELECT concat_ws(',', CASE WHEN event_type = 'error' THEN 'repo_id' END,
                                    CASE WHEN user_id % 3 = 0 THEN 'full_name' END,
                                    CASE WHEN event_type = 'view' THEN 'stargazers_count' END) AS missing FROM events)
            WHERE missing <> '' GROUP BY 1""",
        "stream_redelivered": """
            SELECT 'owner' || user_id AS owner_login, count(*) AS deliveries, sum(event_id)::BIGINT AS stars
            FROM events GROUP BY 1""",
        "repos_snapshot_keep_deleted": _with([HISTORY], HISTORY_OUT + "history"),
        "dq_casts": _with([ISSUES], """
            SELECT 'issues' AS resource, column_name, (SELECT count(*) FROM issues) AS rows,
                   CASE WHEN column_name = 'comments_count' THEN (SELECT count(*) FROM issues WHERE comments_count = 0)
                        ELSE 0 END AS misfits
            FROM (SELECT unnest(['issue_id', 'issue_number', 'author_id', 'comments_count', 'created_at',
                                 'updated_at', 'closed_at', 'search_score']) AS column_name)"""),
        "replacing_events": """
            SELECT user_id, event_id, ts, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "loaded_payloads": _with([ISSUES], """
            SELECT state, count(DISTINCT issue_id) AS issues, sum(comments_count)::BIGINT AS comments,
                   max(issue_id) AS last_id FROM issues GROUP BY 1"""),
        "quarantined_lines": _with([ISSUES], """
            SELECT created_at::DATE::VARCHAR AS landed_on, CASE WHEN comments_count IS NULL THEN 'unreadable'
                   WHEN comments_count = 0 THEN 'incomplete' ELSE 'loaded' END AS outcome, count(*) AS lines
            FROM issues GROUP BY 1, 2"""),
        "backfilled_days": _with([REPOS], """
            SELECT run_id, count(*) AS repos, count(DISTINCT repo_id) AS ids, sum(stargazers_count)::BIGINT AS stars,
                   count(*) FILTER (WHERE list_contains(topics, 'red')) AS red, max(updated_at) AS last_update
            FROM repos GROUP BY 1"""),
        "dq_source": _with([REPOS, PRS, ISSUES], _rules(SOURCE_CHECKS)),
        "dq_negative_values": _rules([
            ("customer", "no_negative_values", "c_acctbal", "error", "c_acctbal < 0"),
            ("supplier", "no_negative_values", "s_acctbal", "error", "s_acctbal < 0"),
            ("lineitem", "no_negative_values", "l_quantity", "error", "l_quantity < 0"),
        ]),
        "dq_report": _with(
            [HISTORY, PRS, ISSUES, FACT_REPOS, FACT_PRS, FACT_ISSUES, DIM_DATE, DEVELOPERS, TRENDING, ACTIVITY,
             _health("health"), DIM_REPOS], _rules(TABLE_CHECKS)
        ),
    }
    return sql
