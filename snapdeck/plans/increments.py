"""What an incremental build has to do again, and the states it carries on.

A build remembers a fingerprint of every (date, venue) slice: row count and
two order-free sums of row hashes. Slices whose fingerprint differs from the
one of the last build are dirty, whatever day they belong to. From there:

- staging: the dirty days;
- metrics and fact: the dirty days, and the days of the next ``FRAME`` rows of
  each pool whose rows changed (its 7-row average and its 7-row lag reach back
  that far);
- dimensions: what the dirty days' old rows contributed is taken off the state
  and what their new rows contribute is added. Only a pool or token that lost
  the first or last day it was seen on is computed again from staging.

All functions take and return DataFrames; ``plans.job`` reads and writes the
tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapdeck.config import DEFAULT, Config
from snapdeck.operators.joins import bounded_broadcast, join_small, materialize
from snapdeck.plans import dims, models

SLICE = ["snapshot_date", "dex_name"]
DAY = "snapshot_date"
#: Rows of a pool that a row's average and lag reach back over.
FRAME = 7


# ---------------------------------------------------------------------------
# Dirty slices
# ---------------------------------------------------------------------------


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row. Spark's hash passes over nulls,
    so which columns are null is hashed too."""
    values = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit(1), nulls, *values)


def slice_fingerprints(rows: DataFrame) -> DataFrame:
    """(snapshot_date, dex_name, n_rows, sum_a, sum_b): one row a slice. Sums
    don't depend on the order of rows, and combine map-side."""
    a, b = (h.cast("decimal(20,0)") for h in row_hashes(sorted(rows.columns)))  # in whatever order a reader gives them
    return rows.groupBy(*SLICE).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(a).alias("sum_a"), F.sum(b).alias("sum_b"))


def changed_slices(built: DataFrame, current: DataFrame) -> DataFrame:
    """(snapshot_date, dex_name, change, rows_before, rows_after) of slices
    whose fingerprints differ; change is new, gone or changed."""
    tagged = lambda df, side: df.select(
        *[F.col(c).alias(f"{side}_{c}") for c in SLICE], F.struct("n_rows", "sum_a", "sum_b").alias(side)
    )
    b, c = tagged(built, "b"), tagged(current, "c")
    same_slice = F.lit(True)
    for k in SLICE:
        same_slice = same_slice & b[f"b_{k}"].eqNullSafe(c[f"c_{k}"])
    met = b.join(c, same_slice, "full_outer").filter(~F.col("b").eqNullSafe(F.col("c")))
    change = F.when(F.col("b").isNull(), "new").when(F.col("c").isNull(), "gone").otherwise("changed")
    return met.select(
        *[F.coalesce(f"c_{k}", f"b_{k}").alias(k) for k in SLICE],
        change.alias("change"),
        F.coalesce("b.n_rows", F.lit(0)).alias("rows_before"),
        F.coalesce("c.n_rows", F.lit(0)).alias("rows_after"),
    )


def of_days(df: DataFrame, days: DataFrame, how: str = "left_semi", cfg: Config = DEFAULT) -> DataFrame:
    """Rows of ``days`` (or of all others, with left_anti). A day is a row of a
    few bytes, so the side is broadcast after its size check, and a table in
    DAY partitions reads those partitions only."""
    # Spark prunes partitions by a side that holds a comparison (it takes the
    # side for selective then); every date passes this one
    side, small = bounded_broadcast(days.select(DAY), cfg.broadcast_max_bytes)
    side = side.filter(F.col(DAY) > F.lit("0001-01-01").cast("date"))
    return df.join(F.broadcast(side) if small else side, DAY, how).select(*df.columns)


# ---------------------------------------------------------------------------
# Metrics: days carried forward over the frames
# ---------------------------------------------------------------------------


def carried_days(before: DataFrame, after: DataFrame, stg: DataFrame, frame: int = FRAME, cfg: Config = DEFAULT) -> DataFrame:
    """(snapshot_date): days with a row among the ``frame`` rows that follow a
    changed row of the same pool.

    ``before`` and ``after`` are the dirty days' staging rows in the old and in
    the new table, ``stg`` is the new table. Rows that are equal on both sides
    carry nothing on. A pool has at most a few rows a day, so its window is
    bounded by the days from its first change on.
    """
    cols = ["pool_address", *SLICE, "trailing_24h_volume_usd"]
    b, a = before.select(*cols), after.select(*cols)
    pool_days = ["pool_address", DAY]
    changed = materialize(b.exceptAll(a).unionByName(a.exceptAll(b)).select(*pool_days).distinct())
    pools, _ = bounded_broadcast(changed.groupBy("pool_address").agg(F.min(DAY).alias("_from")), cfg.broadcast_max_bytes)
    rows = stg.select(*pool_days).join(pools, "pool_address").filter(F.col(DAY) >= F.col("_from"))
    events = rows.select(*pool_days, F.lit(0).alias("_change")).unionByName(changed.withColumn("_change", F.lit(1)))
    so_far = Window.partitionBy("pool_address").orderBy(DAY, "_change").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = events.withColumn("_seen", F.count_if(F.col("_change") == 0).over(so_far))
    counted = counted.withColumn("_at", F.max(F.when(F.col("_change") == 1, F.col("_seen"))).over(so_far))
    return counted.filter((F.col("_change") == 0) & (F.col("_seen") - F.col("_at") <= frame)).select(DAY).distinct()


def metrics_of_days(stg: DataFrame, days: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """M3 for the rows of ``days``, equal to ``pool_metrics`` over all of
    staging restricted to those days.

    Reads staging between the first and the last of them, for the pools they
    hold, and those pools' last rows before (top-7 per partition ahead of the
    exchange). All rows of the days are there, so their totals are complete.
    """
    lo, hi = days.agg(F.min(DAY), F.max(DAY)).first()
    if lo is None:
        return models.pool_metrics(stg.limit(0), cfg)
    pools, _ = bounded_broadcast(of_days(stg.select(DAY, "pool_address"), days, cfg=cfg).select("pool_address").distinct(), cfg.broadcast_max_bytes)
    current = stg.filter((F.col(DAY) >= F.lit(lo)) & (F.col(DAY) <= F.lit(hi))).join(pools, "pool_address", "left_semi")
    # a few rows a pool, stored: the totals and the windows both read them
    prior = materialize(models.last_rows_per_pool(stg.filter(F.col(DAY) < F.lit(lo)).join(pools, "pool_address", "left_semi"), FRAME))
    # totals of the days in between are of those pools only, and not returned
    return of_days(models.pool_metrics(current.unionByName(prior), cfg), days, cfg=cfg)


# ---------------------------------------------------------------------------
# Dimension states: old days off, new days on
# ---------------------------------------------------------------------------


def _carried_on(
    state: DataFrame,
    before: DataFrame,
    after: DataFrame,
    days: DataFrame,
    key: str,
    sums: dict[str, str],
    counts: Sequence[str],
    cfg: Config,
) -> tuple[DataFrame, DataFrame]:
    """(state without the keys to compute again, those keys).

    ``before`` and ``after`` are states of the dirty days' old and new rows.
    ``sums`` are the additive columns and their types; a key without any of
    ``counts`` left is gone.
    """
    fd = bounded_broadcast(days.select(F.col(DAY).alias("_fd")), cfg.broadcast_max_bytes)[0]
    ld = bounded_broadcast(days.select(F.col(DAY).alias("_ld")), cfg.broadcast_max_bytes)[0]
    old = state.join(fd, F.col("first_seen_date") == F.col("_fd"), "left").join(ld, F.col("last_seen_date") == F.col("_ld"), "left")
    absent = lambda c: F.lit(None).cast(state.schema[c].dataType)
    day = lambda c: F.col(c).cast("date")
    nothing = F.lit(None).cast("date")
    parts = [
        old.select(
            key,
            F.when(F.col("_ld").isNull(), F.col("_m")).alias("_m"),
            F.when(F.col("_fd").isNull(), day("first_seen_date")).alias("first_seen_date"),
            F.when(F.col("_ld").isNull(), day("last_seen_date")).alias("last_seen_date"),
            F.col("_fd").alias("_lost_first"),
            F.col("_ld").alias("_lost_last"),
            nothing.alias("_new_first"),
            nothing.alias("_new_last"),
            *sums,
        ),
        before.select(
            key,
            absent("_m").alias("_m"),
            *[nothing.alias(c) for c in ("first_seen_date", "last_seen_date", "_lost_first", "_lost_last", "_new_first", "_new_last")],
            *[(-F.col(c)).cast(t).alias(c) for c, t in sums.items()],
        ),
        after.select(
            key,
            "_m",
            "first_seen_date",
            "last_seen_date",
            nothing.alias("_lost_first"),
            nothing.alias("_lost_last"),
            F.col("first_seen_date").alias("_new_first"),
            F.col("last_seen_date").alias("_new_last"),
            *sums,
        ),
    ]
    met = parts[0].unionByName(parts[1]).unionByName(parts[2])
    lowest, highest = ("_m", "first_seen_date", "_lost_first", "_new_first"), ("last_seen_date", "_lost_last", "_new_last")
    out = met.groupBy(key).agg(
        *[F.min(c).alias(c) for c in lowest],
        *[F.max(c).alias(c) for c in highest],
        *[F.sum(c).cast(t).alias(c) for c, t in sums.items()],
    )
    there = sum((F.col(c) for c in counts[1:]), F.col(counts[0])) > 0
    # the key left its first or its last day: which one is next, only staging knows
    again = (F.col("_lost_first").isNotNull() & F.coalesce(F.col("_new_first") > F.col("_lost_first"), F.lit(True))) | (
        F.col("_lost_last").isNotNull() & F.coalesce(F.col("_new_last") < F.col("_lost_last"), F.lit(True))
    )
    out = materialize(out.filter(there).withColumn("_again", again))
    return out.filter("NOT _again").select(*state.columns), out.filter("_again").select(key)


def pool_state_after(
    state: DataFrame, before: DataFrame, after: DataFrame, days: DataFrame, stg: DataFrame, cfg: Config = DEFAULT
) -> DataFrame:
    """The pool state of the new staging table from that of the old one."""
    measure = "decimal(38,9)"
    sums = {"lifetime_observed_volume_usd": measure, "lifetime_observed_fees_usd": measure, "snapshot_days_count": "long", "_fee_rows": "long"}
    kept, again = _carried_on(
        state, dims.pool_state(before), dims.pool_state(after), days, "pool_address", sums, ["snapshot_days_count"], cfg
    )
    # without a fee row left the sum is null, not zero
    fees = F.when(F.col("_fee_rows") > 0, F.col("lifetime_observed_fees_usd"))
    kept = kept.withColumn("lifetime_observed_fees_usd", fees)
    return _with_again(kept, again, lambda pools: dims.pool_state(join_small(stg, pools, ["pool_address"], "left_semi", cfg.broadcast_max_bytes)))


def token_state_after(
    state: DataFrame, before: DataFrame, after: DataFrame, days: DataFrame, stg: DataFrame, cfg: Config = DEFAULT
) -> DataFrame:
    """The token state of the new staging table from that of the old one."""
    sums = {"appears_as_base_count": "long", "appears_as_quote_count": "long"}
    kept, again = _carried_on(
        state, dims.token_state(before), dims.token_state(after), days, "token_address", sums, list(sums), cfg
    )

    def computed(tokens: DataFrame) -> DataFrame:
        rows = dims.token_appearances(stg)
        return dims.token_state_from(join_small(rows, tokens, ["token_address"], "left_semi", cfg.broadcast_max_bytes))

    return _with_again(kept, again, computed)


def _with_again(kept: DataFrame, again: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Staging is read for the keys to compute again, and only if there are any."""
    if again.isEmpty():
        return kept
    return kept.unionByName(compute(again).select(*kept.columns))


def last_rows_after(state: DataFrame, after: DataFrame, days: DataFrame, stg: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Each pool's newest ``FRAME`` rows in the new staging table from those in
    the old one. A pool that lost one of them is read from staging, where its
    next older row is."""
    row = ["pool_address", *SLICE]
    stale = of_days(state, days, cfg=cfg)
    lost = materialize(stale.select(*row).join(after.select(*row), row, "left_anti").select("pool_address").distinct())
    merged = of_days(state, days, "left_anti", cfg).unionByName(after.select(*state.columns))
    if lost.isEmpty():
        return models.last_rows_per_pool(merged, FRAME)
    kept = join_small(merged, lost, ["pool_address"], "left_anti", cfg.broadcast_max_bytes)
    again = join_small(stg, lost, ["pool_address"], "left_semi", cfg.broadcast_max_bytes).select(*state.columns)
    return models.last_rows_per_pool(kept.unionByName(again), FRAME)
