"""Joins whose broadcast side is size-checked, with a shuffle join beyond the bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck.session import scratch_path

#: Bytes up to which a measured side is broadcast.
BROADCAST_BYTES = 64 << 20


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table below the shared checkpoint folder and
    read it back: lineage is cut in a place that survives lost executors, and
    later reads prune columns and skip row groups."""
    path = scratch_path(df.sparkSession, "materialized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(schema: T.StructType) -> Column:
    """The width of a row: text, binary and nested values are measured."""
    width = F.lit(0).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            width = width + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16
        else:
            width = width + 16
    return width


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialize a candidate build side, measure it, and hint a broadcast
    only within ``max_bytes``. Returns (side, broadcast?).

    The measure reads the table just written; above the bound the caller's
    join shuffles (AQE still splits skewed partitions there).
    """
    m = materialize(df)
    n = m.agg(F.sum(row_bytes(m.schema)).alias("n")).first()["n"] or 0
    if n <= max_bytes:
        return F.broadcast(m), True
    return m, False


def join_small(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``big`` to a side expected to be small (dimension, per-group totals).

    Broadcast when the measured size allows (no shuffle of ``big``); otherwise
    a shuffle join. ``null_safe`` matches NULL keys to each other, like a
    window PARTITION BY would group them.
    """
    if not null_safe:
        side, _ = bounded_broadcast(small, max_bytes)
        return big.join(side, list(keys), how)
    renamed, _ = bounded_broadcast(
        small.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in small.columns]), max_bytes
    )
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = big.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])
