"""Reusable relational operators that Spark has no single call for."""

from .asof import asof_join
from .latest import first_by, latest_by
from .scd2 import advance, as_of, current, number_runs, replay

__all__ = ["advance", "as_of", "asof_join", "current", "first_by", "latest_by", "number_runs", "replay"]
