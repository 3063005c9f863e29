"""Classification and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest star count of each tier, and the tier below all of them.
STAR_TIERS = {"high": 1000, "medium": 100, "low": 10}
LOWEST_TIER = "minimal"


def star_tier(stars: Column) -> Column:
    """Tier name of a star count; an unknown count is in the lowest tier."""
    reached = [F.when(stars >= floor, F.lit(name)) for name, floor in STAR_TIERS.items()]
    return F.coalesce(*reached, F.lit(LOWEST_TIER))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with one decimal; NULL when there is no whole.

    Decimal arithmetic with six digits for the quotient, so that a half is
    rounded up where a double would fall just short of it.
    """
    quotient = F.round(part.cast("decimal(18,0)") / whole.cast("decimal(18,0)"), 6)
    return F.when(whole > 0, F.round(quotient * 100, 1).cast("double"))
