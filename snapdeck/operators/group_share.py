"""Share of a group total: each row's measure against its group's sum.

Scale form: totals come from a partial (map-side) aggregation, one row per
group, joined back through a size-checked broadcast. The big table is never
shuffled by the group key, so a group holding a third of all rows costs no
more than any other. The window form is kept as a test twin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdeck.operators.joins import BROADCAST_BYTES, join_small


def add_group_totals(
    df: DataFrame,
    measure: str,
    levels: Sequence[tuple[Sequence[str], str]],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add one total column per level; levels must nest (finest first).

    ``levels=[(["snapshot_date","dex_name"], "dex_total"), (["snapshot_date"], "market_total")]``
    sums the measure per (date, venue), derives the per-date totals from that
    small table, and joins both back in one broadcast join.
    """
    finest_keys, finest_name = levels[0]
    totals = df.groupBy(*finest_keys).agg(F.sum(measure).alias(finest_name))
    for keys, name in levels[1:]:
        if not set(keys) <= set(finest_keys):
            raise ValueError("levels must nest inside the finest level")
        # the totals table has one row per finest group: a window over it is cheap
        totals = totals.withColumn(name, F.sum(finest_name).over(Window.partitionBy(*keys)))
    return join_small(df, totals, finest_keys, how="inner", max_bytes=max_bytes, null_safe=True)


def add_group_totals_window(df: DataFrame, measure: str, levels: Sequence[tuple[Sequence[str], str]]) -> DataFrame:
    """Window twin of :func:`add_group_totals` (one task per group: test use only)."""
    for keys, name in levels:
        df = df.withColumn(name, F.sum(measure).over(Window.partitionBy(*keys)))
    return df
