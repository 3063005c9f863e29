"""Differences counted in calendar boundaries, not in elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_boundaries(start: Column, end: Column) -> Column:
    """Full hours on the clock passed from ``start`` to ``end``: 07:59 to 08:01 is 1."""
    seconds = F.unix_seconds(F.date_trunc("hour", end)) - F.unix_seconds(F.date_trunc("hour", start))
    return (seconds / 3600).cast("bigint")


def day_boundaries(start: Column, end: Column) -> Column:
    """Midnights passed from ``start`` to ``end``."""
    return F.datediff(end, start)
