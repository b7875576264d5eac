"""Declared column tests of every raw table and model: what must not be null,
what must be unique. The build gates on all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapdeck.operators import checks as ck

# The declarations.
_POOLS = ["snapshot_date", "snapshot_at", "dex_name", "pool_address", "trailing_24h_volume_usd"]
NOT_NULL = {
    "raw_dex_pools": _POOLS,
    "raw_dex_market_share": ["snapshot_date", "snapshot_at", "dex_name"],
    "stg_dex_pools": _POOLS,
    "stg_dex_market_share": ["snapshot_date", "dex_name"],
    "fct_pool_trailing_24h": ["pool_snapshot_key", "snapshot_date", "dex_name", "pool_address", "trailing_24h_volume_usd"],
    "fct_dex_market_share_daily": ["market_share_snapshot_key", "snapshot_date"],
    "dim_pool": ["pool_key", "pool_address"],
    "dim_token": ["token_key", "token_address"],
    "dim_date": ["date_key", "calendar_date"],
}
UNIQUE = {
    "fct_pool_trailing_24h": ["pool_snapshot_key"],
    "fct_dex_market_share_daily": ["market_share_snapshot_key"],
    "dim_pool": ["pool_key", "pool_address"],
    "dim_token": ["token_key", "token_address"],
    "dim_date": ["date_key", "calendar_date"],
}


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_results(tables: dict[str, DataFrame]) -> DataFrame:
    """One aggregate pass for each table, a row for each declaration."""
    return _all([ck.row_level_suite(df, name, ck.not_null(NOT_NULL[name])) for name, df in tables.items() if name in NOT_NULL])


def unique_results(tables: dict[str, DataFrame]) -> DataFrame:
    """One exchange for each table, a row for each declaration."""
    return _all([ck.unique_suite(df, name, [[c] for c in UNIQUE[name]]) for name, df in tables.items() if name in UNIQUE])
