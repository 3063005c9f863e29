from __future__ import annotations

import json

import pytest
from samples import raw_of, sample_payloads
from pyspark.sql import Observation
from pyspark.sql import functions as F

from forgelens.operators import quality as q
from forgelens.plans import contracts
from forgelens.plans.staging import stage


def outcome(df) -> dict:
    return {(r.rule, r.column_name): (r.n_checked, r.n_failed, r.passed) for r in df.collect()}


@pytest.fixture(scope="module")
def table(spark):
    data = [(1, "open", 5, "x"), (1, "closed", -1, ""), (None, "odd", None, None), (2, None, 200, "y"), (3, "open", 0, "z")]
    return spark.createDataFrame(data, "id INT, state STRING, n INT, title STRING")


def test_exact_counts_of_every_rule(spark, table):
    parents = {"ids": spark.createDataFrame([(1,), (1,), (3,), (None,)], "k INT")}
    rules = [
        q.not_null("id"),
        q.unique("id"),
        q.unique("title"),
        q.accepted_values("state", ["open", "closed"]),
        q.is_true("n", ">= 0"),
        q.is_true("id", "> 1", where="state = 'open'"),
        q.not_negative("n"),
        q.between("n", low=0, high=100, severity="warn"),
        q.length_between("title", 1, 500),
        q.references("id", "ids", "k"),
        q.row_count(low=1, high=4),
        q.column_exists("id"),
        q.column_exists("absent"),
    ]
    assert outcome(q.evaluate("t", table, rules, parents)) == {
        ("not_null", "id"): (5, 1, False),
        ("unique", "id"): (5, 1, False),
        ("unique", "title"): (5, 0, True),
        ("accepted_values", "state"): (5, 1, False),
        ("is_true(>= 0)", "n"): (5, 1, False),
        ("is_true(> 1)", "id"): (2, 1, False),
        ("no_negative_values", "n"): (5, 1, False),
        ("between", "n"): (5, 2, False),
        ("length_between", "title"): (5, 1, False),
        ("relationships", "id"): (5, 1, False),
        ("row_count_between", "*"): (5, 1, False),
        ("column_exists", "id"): (1, 0, True),
        ("column_exists", "absent"): (1, 1, False),
    }


def test_limits_are_inclusive_unless_strict(spark, table):
    loose, strict = q.between("n", low=0, high=200), q.between("n", low=0, high=200, strictly=True)
    assert [outcome(q.evaluate("t", table, [r]))[("between", "n")][1] for r in (loose, strict)] == [1, 3]


def test_empty_table(spark, table):
    empty = table.filter("false")
    rules = [q.not_null("id"), q.unique("id"), q.row_count(low=1), q.references("id", "ids", "k")]
    result = outcome(q.evaluate("t", empty, rules, {"ids": spark.createDataFrame([(1,)], "k INT")}))
    assert {k: v[1] for k, v in result.items()} == {
        ("not_null", "id"): 0, ("unique", "id"): 0, ("row_count_between", "*"): 1, ("relationships", "id"): 0
    }


def test_only_errors_stop(spark, table):
    warned = q.enforce(q.evaluate("t", table, [q.not_null("id", severity="warn")]))
    assert [r.rule for r in warned] == ["not_null"]
    with pytest.raises(q.QualityError, match="t.id not_null: 1"):
        q.enforce(q.evaluate("t", table, [q.not_null("id"), q.not_null("state", severity="warn")]))


def test_unknown_severity_is_refused():
    with pytest.raises(ValueError):
        q.not_null("id", severity="fatal")


def test_frequent_values_are_reduced_before_they_move(spark):
    """A value in a third of the rows reaches the exchange as one partial count."""
    frame = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k")
    parents = {"p": spark.range(10).withColumnRenamed("id", "k")}
    for rule in (q.unique("k"), q.references("k", "p", "k")):
        result = q.evaluate("t", frame, [rule], parents)
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")
    assert outcome(q.evaluate("t", frame, [q.unique("k")]))[("unique", "k")] == (3000, 1, False)


def test_number_of_declared_rules():
    rules = [r for table in contracts.TABLE_RULES.values() for r in table]
    assert len(rules) == 99 and sum(r.severity == "warn" for r in rules) == 5


def test_source_contract_holds_for_the_samples(spark):
    for resource, payloads in sample_payloads().items():
        shape = "id BIGINT, full_name STRING, stargazers_count BIGINT, language STRING, title STRING, state STRING, comments BIGINT"
        lines = spark.createDataFrame([(json.dumps(p),) for p in payloads], "line STRING")
        frame = lines.select(F.from_json("line", shape).alias("p")).select("p.*")
        result = q.evaluate(resource, frame, contracts.SOURCE_RULES[resource])
        assert q.enforce(result) == []


def test_quotes_in_accepted_values(spark):
    rows_ = spark.createDataFrame([("O'Neil",), ("a\\b",), ("other",)], "name STRING")
    (found,) = q.evaluate("t", rows_, [q.accepted_values("name", ["O'Neil", "a\\b"])]).collect()
    assert (found.n_checked, found.n_failed) == (3, 1)


def test_rules_counted_while_writing_equal_a_second_read(spark, table, tmp_path):
    rules = [q.not_null("id"), q.unique("id"), q.accepted_values("state", ["open"]), q.row_count(low=9),
             q.is_true("id", "> 1", where="state = 'open'"), q.column_exists("absent"), q.references("id", "ids", "k")]
    parents = {"ids": spark.createDataFrame([(1,), (3,)], "k INT")}
    seen = Observation()
    table.repartition(3).observe(seen, *q.counters(rules)).write.parquet(str(tmp_path / "t"))
    written = spark.read.parquet(str(tmp_path / "t"))
    result = q.evaluate("t", written, rules, parents, seen.get)
    assert outcome(result) == outcome(q.evaluate("t", table, rules, parents))
    # Only keys are read again, in one scan and one exchange.
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "state#" not in plan.split("Relation [")[0].split("Project [id")[-1]
    empty = Observation()
    table.filter("n > 10000").observe(empty, *q.counters(rules)).write.parquet(str(tmp_path / "e"))
    assert outcome(q.evaluate("t", table.filter("false"), rules, parents, empty.get))[("not_null", "id")] == (0, 0, True)


def test_values_that_do_not_fit_are_counted_by_rules(spark):
    payloads = sample_payloads()
    payloads["issues"][0]["comments"] = "many"
    payloads["issues"][1]["created_at"] = "yesterday"
    raw = raw_of(spark, "issues", payloads["issues"])
    result = outcome(q.evaluate("stg_issues", stage(raw, "issues", flagged=True), contracts.CAST_RULES["stg_issues"]))
    failed = {column: n[1] for (rule, column), n in result.items() if n[1]}
    assert failed == {"comments_count": 1, "created_at": 1} and len(result) == 8
