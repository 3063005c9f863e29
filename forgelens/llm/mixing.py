"""Mixing sources to target weights.

Tokens are summed per source, targets follow from the sources' weights, and a
document is emitted ``floor(rate)`` times plus one more time with the rate's
fraction as probability, drawn by a hash of a seed and the document's id.

Null texts count no words.  A null source is a source of its own, the last one.
Rows that share a ``doc_id`` share their draw; rows without one draw by their
text.  A source without words has rate 0.  An empty table gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
# A draw is 52 bits of a digest, which a double holds exactly.
DRAW_BITS = 52
WIDE = "decimal(38,0)"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source of ``sized`` (source, size) with its weight, target and rate.

    Sources in code-point order take ``weights`` in turn and share all sizes;
    none gets more than ``most`` times its own size, and what exceeds that is
    shared again by weight.  Shares are compared as whole numbers, so rounding
    cannot move a source across its limit.  Only sums come to the driver.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = common.numbered(sums, [F.col("source").asc_nulls_last()], "place", "mix-sources")
    turn = F.array(*[F.lit(w) for w in weights])
    sources = common.stored(
        ranked.withColumn("weight", F.get(turn, (F.col("place") % len(weights)).cast("int"))), "mix-weights"
    )
    limit = (F.col("source_size") * most).cast(WIDE)
    words, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    left, shares, above, full = words or 0, weight or 1, F.lit(False), -1
    while True:  # each round fills at least one more source, or is the last
        claim = F.col("weight").cast(WIDE) * F.lit(Decimal(left))
        above = limit * F.lit(Decimal(shares)).cast(WIDE) < claim.cast(WIDE)
        filled = sources.filter(above).agg(F.count("*"), F.sum("source_size"), F.sum("weight")).first()
        if filled[0] <= max(full, 0):
            break
        full = filled[0]
        left, shares = words - most * filled[1], weight - filled[2]
    share = (F.col("weight").cast(WIDE) * F.lit(Decimal(left))).cast("double") / F.lit(float(shares))
    target = F.when(above, limit.cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.withColumn("target", target).withColumn("rate", F.least(rate, F.lit(float(most))))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the document only."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, DRAW_BITS // 4)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << DRAW_BITS))


def copies(rate: Column, drawn: Column) -> Column:
    """How often a document is emitted."""
    return F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")


def plan_mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED
) -> DataFrame:
    """Per document: doc_id, size, its source's size and target, the copies to emit."""
    sized = common.stored(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            common.word_count(F.col("text")).alias("size"),
            draw(F.col("doc_id"), F.col("text"), seed).alias("drawn"),
        ),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, most).select(
        F.col("source").alias("of"), "source_size", "weight", "target", "rate"
    )
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", copies(F.col("rate"), F.col("drawn")))
        .select("doc_id", "source", "size", "source_size", "weight", "target", "rate", "copies")
    )


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: rows of ``documents``, each as often as its source's rate says."""
    sized = common.stored(
        documents.select(F.col("source").cast("string").alias("source"), common.word_count(F.col("text")).alias("size"))
        .groupBy("source")
        .agg(F.sum("size").alias("size")),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, most).select(F.col("source").alias("of"), "rate")
    rows = documents.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("key"),
        draw(F.col("doc_id"), F.col("text"), seed).alias("drawn"),
    )
    return (
        rows.join(targets, F.col("key").eqNullSafe(F.col("of")))
        .withColumn("copies", copies(F.col("rate"), F.col("drawn")))
        .filter("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("row.*")
    )
