"""Quality rules, mixing and URL filter: odd rows, and results worked out by hand."""

from __future__ import annotations

import random

import pytest
from corpora import documents
from pyspark.sql import functions as F

from forgelens.llm import mixing, quality_rules, url_filter


def by_plan(df):
    """Names of physical operators that run Python."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [word for word in ("Python", "Pandas", "Arrow") if word in plan]


def repeated(words):
    """Words in three-word windows that occur twice or more, counted plainly."""
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(covered)


def test_quality_counts_equal_a_plain_count(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab c d, e".split()) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    texts += ["x\ny\nx\n\n \nx", "#a *b |c", "a b c a b c a b c", "a a a a a"]
    rows = quality_rules.judge(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    for row in rows:
        text = texts[row["row"]["doc_id"]]
        words = text.split()
        lines = [line for line in text.split("\n") if line.split()]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == repeated(words)
        assert row["base_failed"] and not row["kept"]


def test_quality_rejects_text_unlike_its_language(spark):
    rng = random.Random(5)
    usual = "the of and to in that was house tree river stone light water mountain table number".split()
    strange = [f"{a}{b}" for a in ("XQ", "ZK", "WV") for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    rows = [(i, " ".join(rng.choice(usual) for _ in range(300)), "en", "s") for i in range(40)]
    rows += [(100 + i, " ".join(rng.choice(strange) + "!" for _ in range(300)), "en", "s") for i in range(3)]
    judged = {r["row"]["doc_id"]: r["kept"] for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert [i for i, kept in judged.items() if not kept] == [100, 101, 102]


def quality_texts():
    rng = random.Random(15)
    usual = "the of and to in that was house tree river stone light water mountain table number".split()
    german = "der die und in den von Haus Baum Wasser Stein Licht Tisch Zahl Berg".split()
    text = lambda words: " ".join(rng.choice(words) for _ in range(300))
    junk = lambda: " ".join(f"{rng.choice('#*$%&|<>')}{rng.randrange(10**6)}{rng.choice('#*$%&|<>')}" for _ in range(220))
    return lambda: text(usual), lambda: text(german), junk


def kept_of(spark, rows):
    return {r["row"]["doc_id"] for r in quality_rules.judge(documents(spark, rows)).filter("kept").collect()}


def test_quality_of_a_language_of_one_document(spark):
    english, german, junk = quality_texts()
    rows = [(i, english(), "en", "s") for i in range(40)] + [(100 + i, german(), "de", "s") for i in range(15)]
    copied = junk()
    rows += [(200, junk(), "xx", "s"), (201, junk(), None, "s"), *[(210 + i, copied, "yy", "s") for i in range(30)]]
    rows += [(300, english(), "zz", "s"), (301, german(), None, "s")]
    assert kept_of(spark, rows) == {*range(40), *range(100, 115), 300, 301}


def test_quality_of_a_language_with_a_third_of_junk(spark):
    english, _, junk = quality_texts()
    rows = [(i, english(), "en", "s") for i in range(40)] + [(100 + i, junk(), "en", "s") for i in range(20)]
    assert kept_of(spark, rows) == set(range(40))


def test_one_long_text_is_not_the_reference(spark):
    english, _, junk = quality_texts()
    rows = [(i, english(), "en", "s") for i in range(40)] + [(100, " ".join(junk() for _ in range(300)), "en", "s")]
    assert kept_of(spark, rows) == set(range(40))
    copied = junk()
    rows = [(i, english(), "en", "s") for i in range(40)] + [(100 + i, copied, "en", "s") for i in range(200)]
    assert kept_of(spark, rows) == set(range(40))


def test_quality_takes_odd_rows(odd, empty):
    judged = quality_rules.judge(odd, keep=odd.columns)
    rows = {(r["row"]["doc_id"], r["row"]["text"]): r for r in judged.collect()}
    assert judged.count() == odd.count() and not by_plan(judged)
    assert rows[1, None]["n_words"] == 0 and rows[1, None]["base_failed"]
    assert next(r for k, r in rows.items() if k[0] == 5)["n_words"] == 60_000
    assert set(quality_rules.keep_good(odd).columns) == set(odd.columns)
    assert quality_rules.judge(empty).count() == 0


def test_targets_stop_at_three_times_a_source(spark):
    sized = spark.createDataFrame(
        [("a", 100), ("b", 1), ("c", 10), (None, 900)], "source string, size bigint"
    )
    found = {r["source"]: r for r in mixing.source_targets(sized).collect()}
    # Weights 1, 2, 3, 1; b and c are full at 3 and 30, a at 300, the rest is left to the last.
    assert [found[s]["weight"] for s in ("a", "b", "c", None)] == [1, 2, 3, 1]
    assert [found[s]["target"] for s in ("a", "b", "c", None)] == [300.0, 3.0, 30.0, 678.0]


def test_mix_is_near_its_targets_and_agrees_with_itself(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 40), "en", rng.choice("pqr")) for i in range(3000)]
    planned = mixing.plan_mix(documents(spark, rows))
    sums = planned.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")
    )
    for row in sums.collect():
        assert abs(row["taken"] - row["target"]) < 0.1 * row["target"] and row["most"] <= 3
    again = mixing.plan_mix(documents(spark, rows[::-1]))
    assert planned.exceptAll(again).isEmpty() and not by_plan(planned)


def test_mix_takes_odd_rows(odd, empty):
    planned = mixing.plan_mix(odd)
    assert planned.count() == odd.count()
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == planned.agg(F.sum("copies")).first()[0]
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Org/x?y", "a.org", "/x", "org/", "allow"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://m.example.org/es/", "m.example.org", "/es/", "example.org/es/", "block"),
        ("https://borg/x", "borg", "/x", None, None),
        ("https://a.com/fr/1#top", "a.com", "/fr/1", "com/fr/", "allow"),
        ("http://a.org", "a.org", "", None, None),
        ("//a.org/x", "", "", None, "block"),
        (None, "", "", None, "block"),
        ("", "", "", None, "block"),
    ],
)
def test_url_parts_and_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, 0), (1, url, 0)], "page_id bigint, url string, text int")
    rows = url_filter.judge(pages).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert (rows[0]["host"], rows[0]["path"], rows[0]["rule"]) == (host, path, rule)
    assert verdict is None or rows[0]["verdict"] == verdict


def test_url_models_tell_kinds_apart(spark):
    rng = random.Random(2)
    name = lambda letters: "".join(rng.choice(letters) for _ in range(9))
    urls = [f"http://{name('aeiou')}.org/{name('aeiou')}" for _ in range(300)]
    urls += [f"http://{name('xqzkw')}.com/de/{name('xqzkw')}" for _ in range(300)]
    urls += [f"http://{name('aeiou')}.net/{name('aeiou')}" for _ in range(30)]
    urls += [f"http://{name('xqzkw')}.net/{name('xqzkw')}" for _ in range(30)]
    judged = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"))
    assert not by_plan(judged)
    rows = {r["page_id"]: r["verdict"] for r in judged.collect()}
    assert all(rows[i] == "allow" for i in range(600, 630)) and all(rows[i] == "block" for i in range(630, 660))


def test_urls_that_differ_in_the_query_alone_are_told_apart(spark):
    urls = [f"http://h{i}.org/p?q=good" for i in range(200)] + [f"http://h{i}.com/de/p?q=casino" for i in range(200)]
    asked = ["http://z.net/p?q=good", "http://z.net/p?q=casino", "http://z.net/p#q=good", None, None, "no url", "no url"]
    frame = spark.createDataFrame(list(enumerate([*urls, *asked])), "page_id bigint, url string")
    clashing = frame.selectExpr("*", "1 AS host", "2 AS path", "'x' AS text", "'y' AS rule", "3 AS score")
    found = {r.page_id: r for r in url_filter.judge(clashing).collect()}
    good, bad, fragment, *others = [found[len(urls) + i] for i in range(len(asked))]
    assert (good.verdict, bad.verdict) == ("allow", "block") and good.score > bad.score and fragment.score > bad.score
    assert {(r.host, r.path, r.rule, r.verdict) for r in others} == {("", "", None, "block")} and len(found) == len(urls) + 7


def test_url_filter_of_nothing_and_of_very_long(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge(pages).count() == 0
    long = spark.createDataFrame([(None, "http://h/" + "ab/" * 50_000)], "page_id bigint, url string")
    assert url_filter.judge(long).first()["path"].endswith("ab/")
