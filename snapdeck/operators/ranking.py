"""Row numbers within groups that do not put a hot group into one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sorts every group in a
single task. Here the rows are range-partitioned on (g, o) instead, so a
group holding a third of all rows spreads over many partitions; each
partition's share is numbered by its local position, and a small table of
per-partition counts gives each share its offset within the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapdeck.operators.joins import BROADCAST_BYTES, join_small, materialize


def row_number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "rn",
    num_partitions: int | None = None,
    max_offset_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``name`` = 1-based position of each row within its ``keys`` group
    under ``order`` (which must be a total order within the group).

    One full exchange (the range partitioning). Inside a partition the rows
    are sorted locally, so a group's rows are contiguous and ordered. Their
    position comes from ``monotonically_increasing_id`` (partition index in
    the high bits, row index in the low 33 bits), materialized so it is
    fixed. The row number is the group's offset from earlier partitions
    plus the position within the partition, minus the group's first position
    there.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort_keys = [F.col(k) for k in keys] + list(order)
    laid = df.repartitionByRange(n, *sort_keys).sortWithinPartitions(*sort_keys)
    local = materialize(laid.withColumn("_mid", F.monotonically_increasing_id()))
    local = local.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_idx", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    firsts = local.groupBy("_pid", *keys).agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per (partition, group) pair: at most #groups + #partitions rows
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.select("_pid", *keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = join_small(local, offsets, ["_pid", *keys], "inner", max_bytes=max_offset_bytes, null_safe=True)
    rn = F.col("_off") + (F.col("_idx") - F.col("_first")) + 1
    return out.withColumn(name, rn.cast("long")).drop("_mid", "_pid", "_idx", "_first", "_off")
