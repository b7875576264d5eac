"""Reporting queries behind the status and analysis panels.

"Latest" filters use a scalar subquery on the date column (pruned to that
column, pushed into the scan); top-k uses ``orderBy().limit()``, which Spark
plans as a per-partition top-k merge, never a full sort into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdeck.config import DEFAULT, Config
from snapdeck.functions import hours_between, ratio_or_zero, status_band, table_type_label
from snapdeck.operators.checks import latest_slice
from snapdeck.sources import lake


def hours_since_last_snapshot(raw_pools: DataFrame, as_of: Column, cfg: Config = DEFAULT) -> DataFrame:
    """V1: whole hours since the newest snapshot, with its traffic-light band."""
    h = raw_pools.agg(F.max("snapshot_at").alias("_last")).select(
        hours_between(as_of, F.col("_last")).alias("hours_since_last_snapshot")
    )
    return h.withColumn("status", status_band("hours_since_last_snapshot"))


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """V2: newest snapshot date and row count per table, one scan each."""
    parts = [
        df.agg(F.max("snapshot_date").alias("last_snapshot"), F.count(F.lit(1)).alias("rows_total")).select(
            F.lit(name).alias("tbl"), "last_snapshot", "rows_total"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("tbl")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same context whose Parquet reader answers counts and
    extremes from file footers (aggregate push-down of the V2 source)."""
    own = spark.newSession()
    listed = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in listed if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_aggregate(spark: SparkSession, path: str, day_col: str = "snapshot_date") -> DataFrame:
    """(last_snapshot, rows_total) of a stored table, from footers alone: no
    row group is read. Days of a DAY-partitioned table are folder names, and
    come from a listing."""
    stored = footer_session(spark).read.parquet(path)
    if not lake.is_partitioned_by(spark, path, day_col):
        return stored.agg(F.max(day_col).alias("last_snapshot"), F.count("*").alias("rows_total"))
    return stored.agg(F.count("*").alias("rows_total"))


def stored_status(spark: SparkSession, tables: dict[str, str], day_col: str = "snapshot_date") -> DataFrame:
    """V2 over stored tables (name -> path): newest snapshot date and row
    count, without reading any row. One row a table reaches the driver."""
    rows = []
    for name, path in tables.items():
        found = footer_aggregate(spark, path, day_col).first()
        last = found["last_snapshot"] if "last_snapshot" in found else lake.day_signatures(spark, path, day_col).agg(F.max(day_col)).first()[0]
        rows.append((name, last, found["rows_total"]))
    return spark.createDataFrame(rows, "tbl string, last_snapshot date, rows_total long").orderBy("tbl")


def rows_vs_7d(raw_pools: DataFrame) -> DataFrame:
    """V3: rows in the latest snapshot vs the rounded mean of the latest 7 daily counts."""
    daily = raw_pools.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("c"))
    last7 = daily.orderBy(F.desc("snapshot_date")).limit(7)
    return last7.agg(
        F.max_by("c", "snapshot_date").alias("rows_today"),
        F.round(F.avg("c")).alias("rows_7d_avg"),
    )


def top_latest(fact: DataFrame, measure: str, k: int, cols: list[str], rank_name: str) -> DataFrame:
    """Top ``k`` rows of the latest snapshot by ``measure`` (ties: pool_address)."""
    latest = latest_slice(fact)
    top = latest.orderBy(F.desc_nulls_last(measure), F.asc("pool_address")).limit(k)
    from pyspark.sql import Window

    w = Window.orderBy(F.desc_nulls_last(measure), F.asc("pool_address"))
    return top.select(*cols).withColumn(rank_name, F.row_number().over(w).cast("long"))


def top_pools_by_fees(fact: DataFrame, k: int = 10) -> DataFrame:
    """V5."""
    cols = ["snapshot_date", "dex_name", "pool_address", "base_token_symbol", "quote_token_symbol", "trailing_24h_fees_usd", "trailing_24h_volume_usd", "fee_rate_pct"]
    return top_latest(fact, "trailing_24h_fees_usd", k, cols, "fee_rank")


def capital_efficiency(fact: DataFrame, k: int = 10) -> DataFrame:
    """V7: volume per unit of liquidity, latest snapshot."""
    cols = ["snapshot_date", "dex_name", "pool_address", "trailing_24h_volume_usd", "tvl_usd", "volume_to_tvl_ratio"]
    return top_latest(fact, "volume_to_tvl_ratio", k, cols, "efficiency_rank")


def fee_rates_established(fact: DataFrame, dim_pool: DataFrame, min_snapshot_days: int) -> DataFrame:
    """V6: fee rates of pools seen on at least ``min_snapshot_days`` days.

    Both inputs are per pool after the fact is aggregated, so the join is
    pool-to-pool (bounded fan-out)."""
    est = dim_pool.filter(F.col("snapshot_days_count") >= min_snapshot_days)
    per_pool = fact.groupBy("pool_key").agg(F.avg("fee_rate_pct").alias("avg_fee_rate_pct"))
    return est.join(per_pool, "pool_key").select(
        "pool_address",
        "dex_name",
        "snapshot_days_count",
        "avg_fee_rate_pct",
        ratio_or_zero("lifetime_observed_fees_usd", "lifetime_observed_volume_usd", 100.0).alias("lifetime_fee_rate_pct"),
    )


def pool_trajectory(fact: DataFrame, pool_address: str | None = None, dim_pool: DataFrame | None = None) -> DataFrame:
    """V8: one pool's daily volume and 7-row average. Without an explicit
    address, the pool with the largest lifetime volume. Its address is a
    scalar subquery: a predicate on the windows' partition key, which Spark
    takes below them, so that only this pool's rows are windowed."""
    if pool_address is not None:
        chosen = fact.filter(F.col("pool_address") == pool_address)
    else:
        top = dim_pool.orderBy(F.desc_nulls_last("lifetime_observed_volume_usd"), F.asc("pool_address")).limit(1).select("pool_address")
        chosen = fact.filter(F.col("pool_address") == top.scalar())
    return chosen.select("snapshot_date", "pool_address", "dex_name", "trailing_24h_volume_usd", "volume_7d_avg").orderBy("snapshot_date")


def venue_volume(fct_ms: DataFrame) -> DataFrame:
    """V9."""
    return fct_ms.select("snapshot_date", "dex_name", "trailing_24h_volume_usd")


def share_over_time(fct_ms: DataFrame) -> DataFrame:
    """V10."""
    return fct_ms.select("snapshot_date", "dex_name", "dex_market_share_pct", "share_7d_avg")


def venue_current(fct_ms: DataFrame) -> DataFrame:
    """V11."""
    return latest_slice(fct_ms).select("snapshot_date", "dex_name", "trailing_24h_volume_usd", "dex_market_share_pct")


def share_change(fct_ms: DataFrame) -> DataFrame:
    """Who gains or loses share against their own 7-row average."""
    ch = F.col("share_change_vs_7d_avg_pct")
    return (
        latest_slice(fct_ms)
        .select(
            "snapshot_date",
            "dex_name",
            "dex_market_share_pct",
            "share_7d_avg",
            "share_change_vs_7d_avg_pct",
            F.when(ch > 0, "gaining").when(ch < 0, "losing").otherwise("flat").alias("trend"),
        )
        .orderBy(F.desc("share_change_vs_7d_avg_pct"))
    )


def storage_by_table(spark, tables: dict[tuple[str, str], str], views: dict[tuple[str, str], DataFrame] | None = None) -> DataFrame:
    """V4: rows and bytes per stored table (bytes = sum of its distinct files'
    sizes from the scan metadata); views are listed with zero rows and bytes."""
    parts = []
    for (schema_name, name), path in tables.items():
        df = spark.read.parquet(path)
        # rows per file, then totals: one aggregation chain gives both numbers
        per_file = df.groupBy(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("file_size")).agg(
            F.count(F.lit(1)).alias("n")
        )
        totals = per_file.agg(F.sum("n").cast("long").alias("total_rows"), F.sum("file_size").cast("long").alias("bytes"))
        parts.append(
            totals.select(
                F.lit(schema_name).alias("table_schema"), F.lit(name).alias("table_name"), table_type_label(F.lit(1)).alias("table_type"), "total_rows", "bytes"
            )
        )
    for (schema_name, name), _df in (views or {}).items():
        parts.append(
            spark.range(1).select(
                F.lit(schema_name).alias("table_schema"),
                F.lit(name).alias("table_name"),
                table_type_label(F.lit(2)).alias("table_type"),
                F.lit(0).cast("long").alias("total_rows"),
                F.lit(0).cast("long").alias("bytes"),
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("bytes"))
