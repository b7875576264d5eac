"""Row frames over ranges instead of keys, for keys that hold many rows.

A window ``PARTITION BY key ORDER BY time ROWS n PRECEDING`` puts all rows of
a key into one task. Here rows are range-partitioned on (key, time), so a hot
key spreads over as many partitions as its rows ask for. A partition that
begins within a key is handed the last ``n`` rows before it (its halo), and
the frames are then computed per (partition, key): they see every row that
they would see in the whole key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from snapdeck.operators.joins import BROADCAST_BYTES, bounded_broadcast, materialize

#: Working columns.
PART, AT, HALO = "_part", "_at", "_halo"


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def with_halo(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, num_partitions: int | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All rows of ``df`` with their range partition in ``_part``, and for each
    partition the ``rows`` rows of its first key that come before it, marked
    by ``_halo``. ``order`` must be total within a key.

    The extra rows are at most ``rows`` a partition. They come from the tails
    (last ``rows`` rows of the last key) of the partitions before: where these
    hold few rows, from several.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    local = materialize(laid.withColumn(AT, F.monotonically_increasing_id()))
    local = local.withColumn(PART, F.shiftright(AT, 33))
    key = F.struct(*keys)
    # a partition's keys are sorted: one row each from here to the halo's
    ends = local.groupBy(PART).agg(F.min(key).alias("_first"), F.max(key).alias("_last"), F.max(AT).alias("_end"))
    ends = materialize(ends)
    side, _ = bounded_broadcast(ends.select(F.col(PART).alias("_p"), "_last", "_end"), max_bytes)
    tails = local.join(side, F.col(PART) == F.col("_p")).filter((F.col(AT) > F.col("_end") - rows) & _same(key, F.col("_last")))
    in_key = Window.partitionBy(*keys).orderBy(AT)
    tails = materialize(tails.withColumn("_rank", F.row_number().over(in_key)).drop("_p", "_last", "_end"))
    # partitions that begin in the key that the one before ends in
    reach = tails.groupBy(PART).agg(F.max("_rank").alias("_reach"))
    in_row = Window.orderBy(PART)  # one row a partition
    follows = ends.join(reach, PART).select(
        PART, "_first", F.lag("_last").over(in_row).alias("_before"), F.lag("_reach").over(in_row).alias("_from")
    )
    follows = follows.filter(_same(F.col("_first"), F.col("_before")) & F.col("_from").isNotNull())
    wanted = follows.select(
        F.col(PART).alias("_to"),
        F.col("_first").alias("_key"),
        F.explode(F.sequence(F.greatest(F.col("_from") - rows + 1, F.lit(1)), F.col("_from"))).alias("_want"),
    )
    wanted, _ = bounded_broadcast(wanted, max_bytes)
    halo = tails.join(wanted, _same(key, F.col("_key")) & (F.col("_rank") == F.col("_want")))
    halo = halo.withColumn(PART, F.col("_to")).select(*df.columns, PART, F.lit(True).alias(HALO))
    return local.select(*df.columns, PART, F.lit(False).alias(HALO)).unionByName(halo)


def row_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    num_partitions: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with ``columns``, each made from the window (keys, order). Their
    frames may reach back over at most ``rows`` rows."""
    spec = Window.partitionBy(PART, *keys).orderBy(*order)
    near = with_halo(df, keys, order, rows, num_partitions, max_bytes)
    framed = near.withColumns({name: make(spec) for name, make in columns.items()})
    return framed.filter(~F.col(HALO)).drop(PART, HALO)
