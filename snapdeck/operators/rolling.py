"""Row-based rolling statistics per entity (the frames count rows, not days)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def entity_window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def rolling_rows_avg(measure: str, keys: Sequence[str], order: Sequence[str], rows: int = 7) -> Column:
    """Mean of the current row and the ``rows - 1`` rows before it; partial frames
    at the start of a series are averaged over what exists."""
    return F.avg(measure).over(entity_window(keys, order).rowsBetween(-(rows - 1), Window.currentRow))


def lag_rows(measure: str, keys: Sequence[str], order: Sequence[str], offset: int = 7) -> Column:
    return F.lag(measure, offset).over(entity_window(keys, order))
