"""Numeric coercion and the two ratio rules of the metric models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapdeck.functions._util import col

# A plain decimal or scientific literal, optionally signed and padded. NaN,
# infinities, '1_000' and '1.0d' do not match and become NULL.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def safe_double(c: Column | str) -> Column:
    """String-or-number to DOUBLE; anything unparseable (or NaN/inf) is NULL.

    ``try_cast`` alone would accept Spark-only forms ('1.0d') and NaN, which
    compares greater than every number in Spark and would pass a floor.
    """
    s = col(c).cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), F.trim(s).try_cast("double"))


def _as_double(c: Column | str) -> Column:
    return col(c).cast("double")


def ratio_or_zero(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """``num / den * scale`` when ``den > 0``, else 0; a NULL numerator stays NULL.

    Computed in DOUBLE: decimal/decimal division in Spark keeps 6 places only.
    """
    q = _as_double(num) / _as_double(den)
    if scale != 1.0:
        q = q * F.lit(scale)
    return F.when(col(den) > 0, q).otherwise(F.lit(0.0))


def ratio_or_null(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """``num / nullif(den, 0) * scale``: NULL when the denominator is NULL or 0."""
    q = _as_double(num) / _as_double(F.nullif(col(den), F.lit(0)))
    if scale != 1.0:
        q = q * F.lit(scale)
    return q
