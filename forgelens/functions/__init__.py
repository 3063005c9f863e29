"""Column expressions shared by the batch relations and the streams."""

from .keys import surrogate_key, version_key
from .measures import percent, star_tier
from .payload import PayloadReader
from .temporal import day_boundaries, hour_boundaries
from .text import repo_slug

__all__ = [
    "PayloadReader",
    "day_boundaries",
    "hour_boundaries",
    "percent",
    "repo_slug",
    "star_tier",
    "surrogate_key",
    "version_key",
]
