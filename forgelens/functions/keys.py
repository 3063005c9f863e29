"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for NULL, and the separator, inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def surrogate_key(*columns: str) -> Column:
    """MD5 over the text of ``columns``; NULL has its own text, so it never drops out."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def version_key(key: str, changed_at: str, run: str) -> Column:
    """Id of one version of a historized row.

    The run is part of it: two versions may carry the same change time when a
    watched column moves and the source does not touch its own timestamp.
    """
    return F.md5(
        F.concat_ws("|", F.col(key).cast("string"), F.unix_micros(changed_at).cast("string"), F.col(run))
    )
