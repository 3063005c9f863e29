"""Version history of repositories and its current and past views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key
from ..operators import advance, as_of, current, latest_by, replay
from ..schemas import WATCHED

# Decides between rows that are equally recent.
TIES = ("airbyte_extracted_at", "airbyte_raw_id")

# Columns of the repository dimension, after its key.
DIMENSION_COLUMNS = (
    "repo_id node_id full_name repo_name owner_login owner_id owner_type language description homepage topics "
    "visibility default_branch license_key license_name is_fork is_archived is_disabled is_private has_issues "
    "has_wiki has_discussions has_pages created_at updated_at pushed_at"
).split()


def repos_snapshot(staged: DataFrame, complete_runs: DataFrame | None = None) -> DataFrame:
    """The whole history, rebuilt from every staged run; see :func:`forgelens.operators.scd2.replay`."""
    return replay(staged, "repo_id", WATCHED, TIES, complete_runs)


def latest_repos(staged: DataFrame) -> DataFrame:
    """The most recent row of each repository, over all runs."""
    return latest_by(staged, ["repo_id"], "extracted_at", TIES)


def advance_repos(
    open_versions: DataFrame | None, staged: DataFrame, run_ts: Column, hard_deletes: str = "close"
) -> DataFrame:
    """One run of the history; see :func:`forgelens.operators.scd2.advance`.

    ``staged`` is all there is: the accumulated rows, or a listing that is complete by itself.
    """
    return advance(open_versions, latest_repos(staged), "repo_id", WATCHED, run_ts, hard_deletes)


def dim_repos(history: DataFrame) -> DataFrame:
    return current(history).select(surrogate_key("repo_id").alias("repo_key"), *DIMENSION_COLUMNS)


def repos_as_of(history: DataFrame, moment: Column) -> DataFrame:
    """The repository dimension as it stood at ``moment``."""
    return as_of(history, moment).select(surrogate_key("repo_id").alias("repo_key"), *DIMENSION_COLUMNS)


def zero_length_versions(history: DataFrame) -> DataFrame:
    """Versions that ended when they started: a watched column moved, the change time did not."""
    return history.filter(F.col("dbt_valid_from") >= F.col("dbt_valid_to"))
