"""URL filters: rules first, then the ratio of two character language models.

URLs that a rule allows train one variable-order Markov model over characters,
URLs that a rule blocks another.  A character's probability after its context
of up to ``ORDER`` characters is interpolated with that after shorter contexts,
by the number of different characters seen there (Witten-Bell); below all is an
equal share for every code point.  The difference of the logarithms, summed
over the URL and divided by its length, is held against a limit that separates
rule-judged URLs best which neither model was trained on.

Rules see host and path; the models see the whole URL, scheme, query and
fragment included, with the host's ASCII letters in lower case.

A null URL, or one without ``://``, has empty host and path and is blocked.
Repeated URLs are scored once and count in the models as often as they occur.
If one kind of URL was never judged by a rule, the limit is 0 and both models
fall back to shorter contexts.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

ALLOW, BLOCK = "allow", "block"

# The rules, each for a host with its subdomains and a path's beginning.
RULES = {
    "org/": ALLOW,
    "example.org/es/": BLOCK,
    "example.org/en/1": BLOCK,
    "com/fr/": ALLOW,
    "com/de/": BLOCK,
}

ORDER = 4
CODE_POINTS = 1_114_112
#: One in so many URLs is kept from training and used to find the limit.
HELD_OUT = 5
#: Log ratios are summed as whole millionths, so that a sum does not depend on its order.
UNIT = 1_000_000
#: Width of the steps in which the limit is sought.
STEP = 0.01
BEGIN, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Parts:
    host: Column
    path: Column
    whole: Column


def parts_of(url: Column) -> Parts:
    """Host (ASCII letters in lower case), path, and the whole with that host; all empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    scheme = F.when(at > 0, F.left(url, at + 2)).otherwise(F.lit(""))
    whole = F.concat(scheme, host, F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1))
    return Parts(host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), whole)


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, begin = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + begin)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def windows(text: Column, order: int = ORDER) -> Column:
    """For each character and the end: the ``order`` characters before it, and itself."""
    chars = F.split(F.concat(F.lit(BEGIN * order), text, F.lit(END)), "")
    one = lambda cs: F.transform(
        F.sequence(F.lit(0), F.length(text)), lambda i: F.concat(*[F.get(cs, i + k) for k in range(order + 1)])
    )
    return F.get(F.transform(F.array(chars), one), F.lit(0))


def train(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``ratio`` (millionths) of every full window in ``grams`` (gram, allowed, blocked: training counts).

    All shorter windows are ends of full ones, so their counts are sums over them.
    """
    full = common.stored(
        grams.groupBy("gram").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")), "url-grams"
    )
    level = None
    for k in range(order + 1):
        counts = full.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(
            F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")
        )
        context = counts.groupBy(F.left("gram", F.lit(k)).alias("context")).agg(
            *[F.sum(c).alias(f"{c}_all") for c in ("allowed", "blocked")],
            *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds") for c in ("allowed", "blocked")],
        )
        counts = counts.withColumn("context", F.left("gram", F.lit(k))).join(context, "context")
        if level is None:
            counts = counts.select("*", *[F.lit(1.0 / CODE_POINTS).alias(f"{c}_lower") for c in ("allowed", "blocked")])
        else:
            shorter = level.select(
                F.col("gram").alias("shorter"), *[F.col(f"{c}_p").alias(f"{c}_lower") for c in ("allowed", "blocked")]
            )
            counts = counts.join(shorter, F.right("gram", F.lit(k)) == F.col("shorter"))
        share = lambda c: F.when(
            F.col(f"{c}_all") > 0,
            (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_lower")) / (F.col(f"{c}_all") + F.col(f"{c}_kinds")),
        ).otherwise(F.col(f"{c}_lower"))
        level = counts.select("gram", *[share(c).alias(f"{c}_p") for c in ("allowed", "blocked")])
        level = common.stored(level, "url-level")
    ratio = F.round((F.ln("allowed_p") - F.ln("blocked_p")) * UNIT).cast("long")
    return level.select("gram", ratio.alias("ratio"))


def best_limit(scored: DataFrame, step: float = STEP) -> float:
    """The score from which on URLs are allowed, as seen on ``scored`` (score, allowed, blocked).

    Scores are counted by steps.  The limit is the middle between two steps that
    have scores, where the mean of both kinds' accuracy is best, of several the
    one nearest to 0, then the smaller.
    """
    steps = scored.groupBy(F.floor(F.col("score") / step).alias("step")).agg(
        F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")
    )
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    kept = F.sum("allowed").over(every) - F.coalesce(F.sum("allowed").over(below), F.lit(0))
    stopped = F.coalesce(F.sum("blocked").over(below), F.lit(0))
    right = F.try_divide(kept, F.sum("allowed").over(every)) + F.try_divide(stopped, F.sum("blocked").over(every))
    last = F.lag("step").over(Window.orderBy("step"))
    twice = (F.col("step") + F.coalesce(last + 1, F.col("step"))).alias("twice")
    best = steps.select("step", right.alias("right"), twice).filter("right is not null")
    found = best.orderBy(F.desc("right"), F.abs("step"), "step").first()
    return found["twice"] * (step / 2) if found else 0.0


def judge(pages: DataFrame, rules: dict[str, str] = RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict and the models' score of every page."""
    parts = parts_of(F.coalesce(F.col("url").cast("string"), F.lit("")))
    plain = (
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            parts.host.alias("host"),
            parts.path.alias("path"),
            parts.whole.alias("text"),
        )
        .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    )
    verdict = F.when(F.col("rule").isin([r for r, v in rules.items() if v == ALLOW]), ALLOW).when(
        F.col("rule").isNotNull(), BLOCK
    )
    held_out = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 8), 16, 10).cast("long") % HELD_OUT == 0
    count = lambda kind: F.when(verdict == kind, F.col("rows")).otherwise(F.lit(0)).alias(kind)
    texts = common.stored(
        plain.groupBy("text", "rule")
        .agg(F.count("*").alias("rows"))
        .select("*", F.monotonically_increasing_id().alias("id"), held_out.alias("held_out"), verdict.alias("verdict")),
        "url-texts",
    ).select("id", "text", "rule", "held_out", count(ALLOW), count(BLOCK))
    placed = texts.filter(F.length("text") > 0).select("*", F.explode(windows(F.col("text"), order)).alias("gram"))
    training = lambda kind: F.when(F.col("held_out"), F.lit(0)).otherwise(F.col(kind))
    model = train(placed.select("gram", training(ALLOW).alias("allowed"), training(BLOCK).alias("blocked")), order)
    sums = placed.select("id", "gram").join(model, "gram").groupBy("id").agg(F.sum("ratio").alias("ratio"))
    scores = common.stored(
        texts.join(sums, "id").select(
            "text",
            (F.col("ratio") / UNIT / (F.length("text") + 1)).alias("score"),
            "rule",
            "held_out",
            F.col(ALLOW).alias("allowed"),
            F.col(BLOCK).alias("blocked"),
        ),
        "url-scores",
    )
    limit = best_limit(scores.filter(F.col("held_out") & F.col("rule").isNotNull()))
    own = F.when(F.col("score") >= limit, ALLOW).otherwise(BLOCK)
    return plain.join(scores.select("text", "score"), "text", "left").select(
        "page_id", "host", "path", "rule", F.coalesce(verdict, own).alias("verdict"), "score"
    )
