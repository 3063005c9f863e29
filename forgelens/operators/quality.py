"""Data-quality rules evaluated as aggregates.

All row rules of a table share one pass over it, or are observed while it is
written.  All rules about keys share another pass, in which the values are
counted before they meet the parents.  Results are rows of :data:`RESULT`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

RESULT = "table_name STRING, rule STRING, column_name STRING, severity STRING, n_checked BIGINT, n_failed BIGINT"
SEVERITIES = ("error", "warn")


@dataclass(frozen=True)
class Rule:
    """One check.  ``fails`` is SQL text that is true for a violating row."""

    name: str
    column: str
    kind: str = "row"  # row, unique, reference, row_count or exists
    fails: str | None = None
    where: str | None = None
    severity: str = "error"
    parent: str | None = None
    parent_column: str | None = None
    low: int | None = None
    high: int | None = None

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"severity must be one of {SEVERITIES}")


def not_null(column: str, severity: str = "error") -> Rule:
    return Rule("not_null", column, fails=f"{column} IS NULL", severity=severity)


def unique(column: str, severity: str = "error") -> Rule:
    """Known values that occur more than once; each counts as one failure."""
    return Rule("unique", column, kind="unique", severity=severity)


def accepted_values(column: str, values: Sequence[str], severity: str = "error") -> Rule:
    escaped = [v.replace("\\", "\\\\").replace("'", "\\'") for v in values]
    listed = ", ".join(f"'{v}'" for v in escaped)
    return Rule("accepted_values", column, fails=f"{column} NOT IN ({listed})", severity=severity)


def is_true(column: str, condition: str, where: str | None = None, severity: str = "error") -> Rule:
    """``condition`` continues the column name, as in ``">= 0"``; unknown passes."""
    return Rule(f"is_true({condition})", column, fails=f"NOT ({column} {condition})", where=where, severity=severity)


def not_negative(column: str, severity: str = "error") -> Rule:
    return Rule("no_negative_values", column, fails=f"{column} < 0", severity=severity)


def between(
    column: str, low: float | None = None, high: float | None = None, strictly: bool = False, severity: str = "error"
) -> Rule:
    below, above = ("<=", ">=") if strictly else ("<", ">")
    sides = [f"{column} {op} {limit}" for op, limit in ((below, low), (above, high)) if limit is not None]
    return Rule("between", column, fails=" OR ".join(sides), severity=severity)


def length_between(column: str, low: int, high: int, severity: str = "error") -> Rule:
    return Rule("length_between", column, fails=f"char_length({column}) NOT BETWEEN {low} AND {high}", severity=severity)


def references(column: str, parent: str, parent_column: str, severity: str = "error") -> Rule:
    """Known values that the parent lacks; every such row counts as one failure."""
    return Rule("relationships", column, kind="reference", parent=parent, parent_column=parent_column, severity=severity)


def fits_type(column: str, severity: str = "error") -> Rule:
    """Values that are there but do not fit the column, by the flag that staging adds."""
    return Rule("fits_type", column, fails=f"`__misfit_{column}`", severity=severity)


def row_count(low: int | None = None, high: int | None = None, severity: str = "error") -> Rule:
    return Rule("row_count_between", "*", kind="row_count", low=low, high=high, severity=severity)


def column_exists(column: str, severity: str = "error") -> Rule:
    return Rule("column_exists", column, kind="exists", severity=severity)


def _entry(table: str, rule: Rule, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.severity).alias("severity"),
        checked.cast("bigint").alias("n_checked"),
        failed.cast("bigint").alias("n_failed"),
    )


def _split(rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    """Rules that counters answer, and rules about keys."""
    keyed = ("unique", "reference")
    return [r for r in rules if r.kind not in keyed], [r for r in rules if r.kind in keyed]


def counters(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates that answer all row rules, for one pass or to be observed while a table is written."""
    found = [F.count("*").alias("rows")]
    for i, rule in enumerate(_split(rules)[0]):
        if rule.fails is not None:
            found.append(F.count_if(F.expr(f"({rule.where or 'true'}) AND ({rule.fails})")).alias(f"f{i}"))
            if rule.where is not None:
                found.append(F.count_if(F.expr(rule.where)).alias(f"c{i}"))
    return found


def _row_results(table: str, totals: DataFrame, columns: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """The one row of :func:`counters` turned into one row per rule."""
    entries = []
    for i, rule in enumerate(rules):
        if rule.kind == "exists":
            failed: Column = F.lit(int(rule.column not in columns))
            checked: Column = F.lit(1)
        elif rule.kind == "row_count":
            rows, bad = F.col("rows"), F.lit(False)
            bad = bad if rule.low is None else bad | (rows < rule.low)
            bad = bad if rule.high is None else bad | (rows > rule.high)
            checked, failed = rows, bad.cast("int")
        else:
            checked = F.col("rows") if rule.where is None else F.col(f"c{i}")
            failed = F.col(f"f{i}")
        entries.append(_entry(table, rule, checked, failed))
    return totals.select(F.inline(F.array(*entries)))


def _key_results(table: str, df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame]) -> DataFrame:
    """All rules about keys in one scan and one exchange: values are tagged with their rule and counted.

    Partial counts are made before the exchange, so a value that fills a third
    of the table travels as one row per input partition, and meets the parents'
    keys as one row.
    """
    text = lambda column: F.col(column).cast("string").alias("v")
    tagged = F.array(*[F.struct(F.lit(i).alias("i"), text(r.column)) for i, r in enumerate(rules)])
    values = df.select(F.inline(tagged)).groupBy("i", "v").agg(F.count("*").alias("n"))
    known = [
        parents[r.parent].select(F.lit(i).alias("of"), text(r.parent_column).alias("p"))
        for i, r in enumerate(rules)
        if r.kind == "reference"
    ]
    held = F.lit(False)
    if known:
        keys = reduce(DataFrame.unionByName, known).distinct()
        values = values.join(keys, (F.col("i") == F.col("of")) & (F.col("v") == F.col("p")), "left")
        held = F.col("p").isNotNull()
    unique = F.col("i").isin([i for i, r in enumerate(rules) if r.kind == "unique"])
    failed = F.when(unique, (F.col("n") > 1).cast("int")).when(~held, F.col("n")).otherwise(0)
    per_rule = values.groupBy("i").agg(
        F.sum("n").alias("checked"), F.sum(F.when(F.col("v").isNotNull(), failed).otherwise(0)).alias("failed")
    )
    # The outer shape holds for an empty table too: each rule then has zero rows.
    summed = per_rule.groupBy().agg(
        *[
            F.coalesce(F.sum(F.when(F.col("i") == i, F.col(c))), F.lit(0)).alias(f"{c}{i}")
            for i in range(len(rules))
            for c in ("checked", "failed")
        ]
    )
    entries = [_entry(table, r, F.col(f"checked{i}"), F.col(f"failed{i}")) for i, r in enumerate(rules)]
    return summed.select(F.inline(F.array(*entries)))


def evaluate(
    table: str,
    df: DataFrame,
    rules: Sequence[Rule],
    parents: Mapping[str, DataFrame] | None = None,
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """Result rows of all rules on one table.

    ``counted`` holds what :func:`counters` gave while the table was written;
    then only the rules about keys read the table again, and of it the keys.
    """
    plain, keyed = _split(rules)
    parts = []
    if plain:
        if counted is None:
            totals = df.agg(*counters(rules))
        else:
            shape = ", ".join(f"{name} BIGINT" for name in counted)
            totals = df.sparkSession.createDataFrame([tuple(counted.values())], shape)
        parts.append(_row_results(table, totals, df.columns, plain))
    if keyed:
        parts.append(_key_results(table, df, keyed, parents or {}))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("n_failed") == 0)


class QualityError(Exception):
    """A rule of severity ``error`` failed."""


def stop_on_errors(failed: Sequence[Row]) -> None:
    """Raise if a result row of severity ``error`` is among the failed ones."""
    errors = [r for r in failed if r.severity == "error"]
    if errors:
        raise QualityError("; ".join(f"{r.table_name}.{r.column_name} {r.rule}: {r.n_failed}" for r in errors))


def enforce(results: DataFrame) -> list[Row]:
    """Raise if an ``error`` rule failed; return the failed ``warn`` rules.

    Only failed result rows come to the driver, at most one per rule.
    """
    failed = results.filter(~F.col("passed")).collect()
    stop_on_errors(failed)
    return failed
