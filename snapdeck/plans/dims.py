"""Dimensions: calendar, pool (type 1) and token (role-playing)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdeck.config import DEFAULT, Config
from snapdeck.functions import (
    day_of_week_sunday,
    is_month_end,
    is_month_start,
    surrogate_key,
    week_sunday,
)
from snapdeck.operators.latest import first_by, newest_first, nulls_last


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day in [start, end) for a one-row ``bounds(start, end)``.

    The spine is bounded by the calendar span (days), not by the data volume.
    """
    return bounds.filter(F.col("end") > F.col("start")).select(
        F.explode(F.sequence(F.col("start"), F.date_sub(F.col("end"), 1), F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )


def date_dim_from_spine(spine: DataFrame) -> DataFrame:
    """Key and calendar attributes per day."""
    d = F.col("date_day")
    return spine.select(
        surrogate_key(d).alias("date_key"),
        d.alias("calendar_date"),
        day_of_week_sunday(d).alias("day_of_week"),
        week_sunday(d).alias("week_number"),
        F.month(d).alias("month_number"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        day_of_week_sunday(d).isin(1, 7).alias("is_weekend"),
        is_month_start(d).alias("is_month_start"),
        is_month_end(d).alias("is_month_end"),
    )


def date_dim(spark: SparkSession, start: dt.date, as_of: dt.date, days_ahead: int = DEFAULT.calendar_days_ahead) -> DataFrame:
    """Calendar from ``start`` up to (excluding) ``as_of + days_ahead``."""
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.date_add(F.lit(as_of), days_ahead).alias("end"))
    return date_dim_from_spine(date_spine(bounds))


def date_dim_for(raw_pools: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Calendar whose "today" is the date of the latest landed run, so the
    dimension always covers every fact date plus ``calendar_days_ahead``."""
    bounds = raw_pools.agg(F.max("snapshot_at").alias("_last")).select(
        F.lit(cfg.calendar_start).alias("start"),
        F.date_add(F.to_date(F.col("_last")), cfg.calendar_days_ahead).alias("end"),
    )
    return date_dim_from_spine(date_spine(bounds))


POOL_META = ["dex_name", "base_token_symbol", "base_token_address", "quote_token_symbol", "quote_token_address"]


def dim_pool(stg: DataFrame) -> DataFrame:
    """D3: latest metadata + lifetime stats per pool in ONE aggregation.

    Replaces window(row_number) + aggregate + join: a single shuffle on
    pool_address, partially aggregated map-side. Latest = newest date, ties
    broken by venue then the metadata values. Distinct days are a per-pool
    set (bounded by the days a pool lives): count(DISTINCT) would add a
    (pool, day) shuffle carrying nearly every staging row.
    """
    return dim_pool_from_state(pool_state(stg))


def token_appearances(stg: DataFrame) -> DataFrame:
    """Both token roles of every pool row from ONE scan (explode of a
    two-element array) instead of two scans and a union."""
    def side(addr: str, sym: str, is_base: int) -> Column:
        return F.struct(
            F.col(addr).alias("token_address"),
            F.col(sym).alias("token_symbol"),
            F.col("snapshot_date").alias("snapshot_date"),
            F.lit(is_base).alias("is_base"),
            F.lit(1 - is_base).alias("is_quote"),
        )

    both = stg.select(
        F.explode(F.array(side("base_token_address", "base_token_symbol", 1), side("quote_token_address", "quote_token_symbol", 0))).alias("t")
    ).select("t.*")
    return both.filter(F.col("token_address").isNotNull())


def dim_token(stg: DataFrame) -> DataFrame:
    """One row per token with its latest symbol and role counts.

    Hot tokens (a stablecoin quoted by most pools) are combined map-side by
    the partial aggregate, never sorted in one task. Latest symbol: newest
    date, then symbol ascending with NULLs last.
    """
    return dim_token_from_state(token_state(stg))


# ---------------------------------------------------------------------------
# Incremental dimensions: mergeable state
# ---------------------------------------------------------------------------


def pool_state(stg: DataFrame) -> DataFrame:
    """Per-pool state of dim_pool: every field merges exactly across
    disjoint day ranges (min of the latest-struct, min/max dates, sums, day
    counts)."""
    latest = first_by([newest_first("snapshot_date"), F.col("dex_name")], POOL_META)
    return stg.groupBy("pool_address").agg(
        latest.alias("_m"),
        F.min("snapshot_date").alias("first_seen_date"),
        F.max("snapshot_date").alias("last_seen_date"),
        F.sum("trailing_24h_volume_usd").alias("lifetime_observed_volume_usd"),
        F.sum("trailing_24h_fees_usd").alias("lifetime_observed_fees_usd"),
        F.size(F.collect_set("snapshot_date")).cast("long").alias("snapshot_days_count"),
        F.count("trailing_24h_fees_usd").alias("_fee_rows"),
    )


def merge_pool_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Combine two pool states built from disjoint day ranges."""
    return old.unionByName(new).groupBy("pool_address").agg(
        F.min("_m").alias("_m"),
        F.min("first_seen_date").alias("first_seen_date"),
        F.max("last_seen_date").alias("last_seen_date"),
        F.sum("lifetime_observed_volume_usd").cast("decimal(38,9)").alias("lifetime_observed_volume_usd"),
        F.sum("lifetime_observed_fees_usd").cast("decimal(38,9)").alias("lifetime_observed_fees_usd"),
        F.sum("snapshot_days_count").cast("long").alias("snapshot_days_count"),
        F.sum("_fee_rows").cast("long").alias("_fee_rows"),
    )


def dim_pool_from_state(state: DataFrame) -> DataFrame:
    return state.select(
        surrogate_key("pool_address").alias("pool_key"),
        "pool_address",
        *[F.col(f"_m.{c}").alias(c) for c in POOL_META],
        "first_seen_date",
        "last_seen_date",
        "lifetime_observed_volume_usd",
        "lifetime_observed_fees_usd",
        "snapshot_days_count",
    )


def token_state(stg: DataFrame) -> DataFrame:
    """Per-token state of dim_token, in two steps: appearances reduce by
    (address, symbol) in hash aggregates of fixed-width values, then the
    latest symbol is picked over the few symbols that an address ever had."""
    return token_state_from(token_appearances(stg))


def token_state_from(appearances: DataFrame) -> DataFrame:
    named = appearances.groupBy("token_address", "token_symbol").agg(
        F.min("snapshot_date").alias("first_seen_date"),
        F.max("snapshot_date").alias("last_seen_date"),
        F.sum("is_base").alias("n_base"),
        F.sum("is_quote").alias("n_quote"),
    )
    latest = first_by([newest_first("last_seen_date"), *nulls_last("token_symbol")], ["token_symbol"])
    return named.groupBy("token_address").agg(
        latest.alias("_m"),
        F.min("first_seen_date").alias("first_seen_date"),
        F.max("last_seen_date").alias("last_seen_date"),
        F.sum("n_base").cast("long").alias("appears_as_base_count"),
        F.sum("n_quote").cast("long").alias("appears_as_quote_count"),
    )


def merge_token_state(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("token_address").agg(
        F.min("_m").alias("_m"),
        F.min("first_seen_date").alias("first_seen_date"),
        F.max("last_seen_date").alias("last_seen_date"),
        F.sum("appears_as_base_count").cast("long").alias("appears_as_base_count"),
        F.sum("appears_as_quote_count").cast("long").alias("appears_as_quote_count"),
    )


def dim_token_from_state(state: DataFrame) -> DataFrame:
    return state.select(
        surrogate_key("token_address").alias("token_key"),
        "token_address",
        F.col("_m.token_symbol").alias("token_symbol"),
        "first_seen_date",
        "last_seen_date",
        "appears_as_base_count",
        "appears_as_quote_count",
    )
