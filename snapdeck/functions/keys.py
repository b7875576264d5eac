"""Deterministic surrogate keys for the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapdeck.config import KEY_NULL_SENTINEL, KEY_SEPARATOR
from snapdeck.functions._util import col


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the string forms of ``cols`` joined by '-', NULLs as a sentinel.

    Same inputs give the same key in every model, so facts join to dimensions
    on it; a NULL input still yields a non-null key.
    """
    parts = [F.coalesce(col(c).cast("string"), F.lit(KEY_NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
