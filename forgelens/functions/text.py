"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repo_slug(url: Column) -> Column:
    """The trailing ``owner/name`` of a URL; NULL unless both parts are there.

    Equal to taking the match of ``[^/]+/[^/]+$`` but without a regex engine:
    cut at the last two slashes, then check that neither side is empty.
    """
    tail = F.substring_index(url, "/", -2)
    return F.when((F.instr(tail, "/") > 1) & ~F.endswith(tail, F.lit("/")), tail)
