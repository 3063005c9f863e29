"""Typed staging relations over the raw envelopes (lazy, never stored)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import PayloadReader, repo_slug
from ..schemas import LOADED_AT, RAW_ID, STAGED
from ..sources.landing import check_resource


# Prefix of the flags that tell a value which is there but does not fit its column.
MISFIT = "__misfit_"


def typed_columns(resource: str) -> dict[str, tuple[str, str]]:
    """Staged columns (payload path, type) that a value may not fit."""
    columns = STAGED[check_resource(resource)]
    return {name: (path, kind) for name, (path, kind) in columns.items() if kind != "string" and not kind.startswith("array")}


def _misfit(reader: PayloadReader, path: str, kind: str) -> str:
    return f"{reader.expression(path, kind)} IS NULL AND {reader.expression(path, 'string')} IS NOT NULL"


def stage(raw: DataFrame, resource: str, keep: Sequence[str] = (), flagged: bool = False) -> DataFrame:
    """Project a raw table to its staged columns, and those it should ``keep`` as they are.

    Casts are forgiving: a value that does not fit becomes NULL.  ``flagged``
    adds a flag per typed column that tells such values, which rules count;
    :func:`misfits` counts them by itself.
    """
    reader = PayloadReader(raw, paths=dict(STAGED[check_resource(resource)].values()))
    flags = typed_columns(resource) if flagged else {}
    staged = reader.frame.selectExpr(
        f"{RAW_ID} AS airbyte_raw_id",
        f"{LOADED_AT} AS airbyte_extracted_at",
        "_run_id AS run_id",
        "CAST(_extracted_at AS TIMESTAMP) AS extracted_at",
        *[f"{reader.expression(path, kind)} AS {name}" for name, (path, kind) in STAGED[resource].items()],
        *[f"{_misfit(reader, path, kind)} AS {MISFIT}{name}" for name, (path, kind) in flags.items()],
        *keep,
    )
    if resource != "repositories":
        staged = staged.withColumn("repo_full_name", repo_slug(F.col("repository_url")))
    if resource == "pull_requests":
        # Tested after the cast: an explicit JSON null means "not merged".
        staged = staged.withColumn("is_merged", F.col("merged_at").isNotNull())
    return staged


def misfits(raw: DataFrame, resource: str) -> DataFrame:
    """Per staged column, the values that are there but do not fit its type, counted in one pass."""
    reader = PayloadReader(raw, paths=dict(STAGED[check_resource(resource)].values()))
    typed = typed_columns(resource)
    counts = [F.count_if(F.expr(_misfit(reader, path, kind))).alias(name) for name, (path, kind) in typed.items()]
    totals = reader.frame.agg(F.count("*").alias("rows"), *counts)
    entries = [F.struct(F.lit(n).alias("column_name"), F.col("rows"), F.col(n).alias("misfits")) for n in typed]
    return totals.select(F.lit(resource).alias("resource"), F.inline(F.array(*entries)))


def stage_repositories(raw: DataFrame) -> DataFrame:
    return stage(raw, "repositories")


def stage_pull_requests(raw: DataFrame) -> DataFrame:
    return stage(raw, "pull_requests")


def stage_issues(raw: DataFrame) -> DataFrame:
    return stage(raw, "issues")
