"""Connected components of a stored graph, by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``id`` and ``component`` (least id of its component) for every end of ``edges`` (a, b).

    Large-star and small-star steps in turn: each vertex hands its neighbours
    the least of them, until every vertex points at the least one it reaches.
    A vertex with many neighbours is reduced to a minimum before any exchange,
    and the join that hands the minimum on can be split by Spark.
    """
    links = common.stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    mark = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    while mark[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
        large = (
            both.filter("b > a")
            .join(least, F.col("a") == F.col("of"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        large = common.stored(large, label)
        least = large.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
        small = large.filter("b <> a").join(least, F.col("a") == F.col("of")).filter("b <> m")
        links = common.stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("of").alias("a"), F.col("m").alias("b")))
            .distinct(),
            label,
        )
        before, mark = mark, links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if before == mark:
            break
    stars = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())
