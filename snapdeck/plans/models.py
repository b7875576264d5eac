"""Staging, intermediate and fact models (pool and market-share chains).

Each model is a function DataFrame -> DataFrame; Catalyst plans a chain as
one query unless a layer is materialized.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapdeck.config import DEFAULT, Config
from snapdeck.functions import canonical_label, ratio_or_null, ratio_or_zero, surrogate_key
from snapdeck.operators.group_share import add_group_totals, add_group_totals_window
from snapdeck.operators.by_range import row_frames
from snapdeck.operators.joins import bounded_broadcast
from snapdeck.operators.rolling import lag_rows, rolling_rows_avg

MEASURE = "decimal(38,9)"


def stg_pools(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """M1: keep snapshots from ``staging_start`` on with a volume, typed columns.

    The date predicate sits on the bare partition column so it prunes a
    partitioned raw table and pushes down into parquet.
    """
    kept = raw.filter((F.col("snapshot_date") >= F.lit(cfg.staging_start)) & F.col("trailing_24h_volume_usd").isNotNull())
    return kept.select(
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
        F.col("snapshot_at").cast("timestamp").alias("snapshot_at"),
        F.col("dex_name").cast("string").alias("dex_name"),
        F.col("pool_address").cast("string").alias("pool_address"),
        F.col("base_token_symbol").cast("string").alias("base_token_symbol"),
        F.col("base_token_address").cast("string").alias("base_token_address"),
        F.col("quote_token_symbol").cast("string").alias("quote_token_symbol"),
        F.col("quote_token_address").cast("string").alias("quote_token_address"),
        F.col("trailing_24h_volume_usd").cast(MEASURE).alias("trailing_24h_volume_usd"),
        F.col("trailing_24h_fees_usd").cast(MEASURE).alias("trailing_24h_fees_usd"),
        F.col("tvl_usd").cast(MEASURE).alias("tvl_usd"),
        F.col("source_file").cast("string").alias("source_file"),
    )


POOL_METRIC_COLUMNS = [
    "snapshot_date",
    "snapshot_at",
    "dex_name",
    "pool_address",
    "base_token_symbol",
    "base_token_address",
    "quote_token_symbol",
    "quote_token_address",
    "trailing_24h_volume_usd",
    "trailing_24h_fees_usd",
    "tvl_usd",
    "source_file",
    "dex_total_24h_volume",
    "market_total_24h_volume",
    "pool_share_of_dex_pct",
    "pool_share_of_market_pct",
    "fee_rate_pct",
    "volume_to_tvl_ratio",
    "volume_7d_avg",
    "volume_wow_pct_change",
]


def pool_metrics(stg: DataFrame, cfg: Config = DEFAULT, totals_form: str = "scale", frames: str = "pool") -> DataFrame:
    """M3: shares of venue and market totals, fee rate, turnover, 7-row average
    and week-on-week change per pool.

    ``frames="range"`` cuts the pools' rows into ranges (with the rows before
    handed over) instead of one task a pool, for snapshots many times a day.

    Plan: venue/day totals by partial aggregation + checked broadcast join
    (no shuffle of the pool rows by date), then ONE shuffle on pool_address
    shared by the rolling average and the lag.
    """
    vol = "trailing_24h_volume_usd"
    levels = [(["snapshot_date", "dex_name"], "dex_total_24h_volume"), (["snapshot_date"], "market_total_24h_volume")]
    if totals_form == "scale":
        base = add_group_totals(stg, vol, levels, max_bytes=cfg.broadcast_max_bytes)
    else:
        base = add_group_totals_window(stg, vol, levels)
    # rows per pool are bounded by the number of snapshot days; dex_name breaks
    # ties of a pool listed under two venues on one date (a fact-check failure)
    keys, order = ["pool_address"], ["snapshot_date", "dex_name"]
    if frames == "range":
        made = {
            "volume_7d_avg": lambda w: F.avg(vol).over(w.rowsBetween(-6, Window.currentRow)).cast("double"),
            "_vol_7_ago": lambda w: F.lag(vol, 7).over(w),
        }
        with_w = row_frames(base, keys, order, 7, made, max_bytes=cfg.broadcast_max_bytes)
    else:
        with_w = base.withColumn("volume_7d_avg", rolling_rows_avg(vol, keys, order).cast("double")).withColumn(
            "_vol_7_ago", lag_rows(vol, keys, order, 7)
        )
    return row_metrics(with_w).select(
        *POOL_METRIC_COLUMNS[:14],
        ratio_or_zero(vol, "dex_total_24h_volume", 100.0).alias("pool_share_of_dex_pct"),
        ratio_or_zero(vol, "market_total_24h_volume", 100.0).alias("pool_share_of_market_pct"),
        "fee_rate_pct",
        "volume_to_tvl_ratio",
        "volume_7d_avg",
        ratio_or_null(F.col(vol) - F.col("_vol_7_ago"), "_vol_7_ago", 100.0).alias("volume_wow_pct_change"),
    )


def row_metrics(stg: DataFrame) -> DataFrame:
    """The metrics of M3 that a row has by itself (fee rate, turnover): no
    totals and no frames, so a filter on a day reaches the scan."""
    vol = "trailing_24h_volume_usd"
    return stg.withColumns(
        {"fee_rate_pct": ratio_or_zero("trailing_24h_fees_usd", vol, 100.0), "volume_to_tvl_ratio": ratio_or_zero(vol, "tvl_usd")}
    )


def fct_pool(metrics: DataFrame) -> DataFrame:
    """M5: the pool fact, keyed for the star joins."""
    return metrics.select(
        surrogate_key("pool_address", "snapshot_date").alias("pool_snapshot_key"),
        surrogate_key("pool_address").alias("pool_key"),
        surrogate_key("base_token_address").alias("base_token_key"),
        surrogate_key("quote_token_address").alias("quote_token_key"),
        *POOL_METRIC_COLUMNS,
    )


def stg_market_share(raw_market: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """M2: canonical venue label, then protocol rows rolled up to venue x day."""
    labelled = raw_market.select(
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
        F.col("snapshot_at").cast("timestamp").alias("snapshot_at"),
        canonical_label("dex_name", cfg.tracked_venues).alias("dex_name"),
        F.col("trailing_24h_volume_usd").cast(MEASURE).alias("trailing_24h_volume_usd"),
        F.col("trailing_7d_volume_usd").cast(MEASURE).alias("trailing_7d_volume_usd"),
        F.col("total_volume_usd").cast(MEASURE).alias("total_volume_usd"),
        F.col("source_file").cast("string").alias("source_file"),
    )
    return labelled.groupBy("snapshot_date", "dex_name").agg(
        F.max("snapshot_at").alias("snapshot_at"),
        F.sum("trailing_24h_volume_usd").alias("trailing_24h_volume_usd"),
        F.sum("trailing_7d_volume_usd").alias("trailing_7d_volume_usd"),
        F.sum("total_volume_usd").alias("total_volume_usd"),
        F.max("source_file").alias("source_file"),
    )


MARKET_METRIC_COLUMNS = [
    "snapshot_date",
    "snapshot_at",
    "dex_name",
    "trailing_24h_volume_usd",
    "trailing_7d_volume_usd",
    "total_volume_usd",
    "source_file",
    "total_market_24h_volume",
    "dex_market_share_pct",
    "share_7d_avg",
    "share_change_vs_7d_avg_pct",
]


def market_share_metrics(stg_ms: DataFrame) -> DataFrame:
    """M4: venue share of the tracked market per day, its 7-row average and
    the gap to it.

    The input is one row per venue and day (a handful of rows per date), so
    both windows are small: the per-date window holds the venues of one day,
    the per-venue window one row per day.
    """
    vol = "trailing_24h_volume_usd"
    w_day = Window.partitionBy("snapshot_date")
    w_venue = Window.partitionBy("dex_name").orderBy("snapshot_date").rowsBetween(-6, Window.currentRow)
    out = (
        stg_ms.withColumn("total_market_24h_volume", F.sum(vol).over(w_day))
        .withColumn("dex_market_share_pct", ratio_or_zero(vol, "total_market_24h_volume", 100.0))
        .withColumn("share_7d_avg", F.avg("dex_market_share_pct").over(w_venue))
        .withColumn("share_change_vs_7d_avg_pct", F.col("dex_market_share_pct") - F.col("share_7d_avg"))
    )
    return out.select(*MARKET_METRIC_COLUMNS)


def fct_market_share(metrics: DataFrame) -> DataFrame:
    """M6: the market-share fact."""
    return metrics.select(
        surrogate_key("dex_name", "snapshot_date").alias("market_share_snapshot_key"),
        "snapshot_date",
        "snapshot_at",
        "dex_name",
        "trailing_24h_volume_usd",
        "trailing_7d_volume_usd",
        "total_volume_usd",
        "total_market_24h_volume",
        "dex_market_share_pct",
        "share_7d_avg",
        "share_change_vs_7d_avg_pct",
        "source_file",
    )


def last_rows_per_pool(df: DataFrame, rows: int = 7) -> DataFrame:
    """The newest ``rows`` staging rows of every pool (the state an incremental
    metric build needs; at most ``rows`` x pools). Spark plans the rank filter
    with a per-partition group limit before the shuffle."""
    w = Window.partitionBy("pool_address").orderBy(F.desc("snapshot_date"), F.desc("dex_name"))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= rows).drop("_r")


def pool_metrics_since(stg: DataFrame, since, cfg: Config = DEFAULT, history: DataFrame | None = None) -> DataFrame:
    """M3 for snapshot dates >= ``since`` only, equal to ``pool_metrics`` over
    all of staging restricted to those dates.

    Reads the staging rows from ``since`` on (partition-pruned on a
    DAY-partitioned table) plus each pool's last 7 rows before ``since``:
    ``history`` (a state table kept by the previous run, see
    :func:`last_rows_per_pool`) or, when absent, derived from the older
    staging rows. Totals are per date, so the new dates' totals are complete.
    """
    start = since if isinstance(since, Column) else F.lit(since)
    current = stg.filter(F.col("snapshot_date") >= start)
    older = (stg if history is None else history).filter(F.col("snapshot_date") < start)
    # pools of the new days as a size-checked broadcast: the older rows are not
    # shuffled for the semi join, and the top-7-per-pool limit runs partially
    # before the one exchange the window needs
    pools, _ = bounded_broadcast(current.select("pool_address").distinct(), cfg.broadcast_max_bytes)
    prior = last_rows_per_pool(older.join(pools, "pool_address", "left_semi"))
    return pool_metrics(current.unionByName(prior), cfg).filter(F.col("snapshot_date") >= start)
