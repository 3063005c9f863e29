"""Totals per owner, kept by what each batch changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.replacing import ReplacingTable

TOTALS = ("repos_count", "total_stars", "total_forks")


class OwnerTotals:
    """True totals per owner over the last row of each repository of ``table``.

    A batch is reduced to the repositories it holds; their rows before and after
    it give a change per owner, which is added to the stored totals of these
    owners alone.  Reading gives the stored totals; no repository is read.
    """

    def __init__(self, spark: SparkSession, path: str, table: ReplacingTable) -> None:
        self._table = table
        self._totals = ReplacingTable(spark, path, "owner_login", ["batch"])

    def change(self, batch: DataFrame, number: int) -> None:
        """Take in a batch before the table does; once more with the same number changes nothing."""
        if self._totals.is_merged(number) or self._table.is_merged(number):
            return
        keys = self._table.keys
        after = batch
        before = None
        if self._table.has(before=number):
            touched = batch.select(*keys).distinct()
            before = self._table.read(before=number).join(touched, keys, "left_semi")
            after = before.unionByName(batch)
        changes = self._signed(self._table.last_per_key(after), F.lit(1))
        if before is not None:
            changes = changes.unionByName(self._signed(before, F.lit(-1)))
        change = changes.groupBy("owner_login").agg(*[F.sum(c).alias(c) for c in TOTALS])
        if self._totals.has(before=number):
            stored = self._totals.read(before=number).join(change.select("owner_login"), "owner_login", "left_semi")
            change = change.unionByName(stored.select("owner_login", *TOTALS))
            change = change.groupBy("owner_login").agg(*[F.sum(c).alias(c) for c in TOTALS])
        self._totals.append(change.withColumn("batch", F.lit(number).cast("bigint")), number)

    @staticmethod
    def _signed(rows: DataFrame, sign: Column) -> DataFrame:
        return rows.filter(F.col("owner_login").isNotNull()).select(
            "owner_login",
            sign.cast("bigint").alias("repos_count"),
            (sign * F.col("stargazers_count")).alias("total_stars"),
            (sign * F.col("forks_count")).alias("total_forks"),
        )

    def merge(self) -> None:
        self._totals.merge()

    def read(self) -> DataFrame:
        """Totals of every owner that still has a repository."""
        return self._totals.read().filter(F.col("repos_count") > 0).select("owner_login", *TOTALS)
