"""One row per key.

Both operators filter a ``row_number`` to 1.  Spark plans that as a partial
group limit before the exchange, so a key that holds a large share of the rows
sends one row per input partition to its reducer, never the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_by(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``by`` per key; an unknown ``by`` counts as highest.

    ``ties`` (highest first, unknown last) make the choice definite.
    """
    order = [F.col(by).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in ties]]
    return _keep_first(df, keys, order)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order; rows without a key share one slot."""
    return _keep_first(df, keys, [F.col(c).asc_nulls_first() for c in order])
