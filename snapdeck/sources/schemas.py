"""Declared schemas: raw tables and the JSON shapes of the four feeds.

Numeric leaves of the JSON feeds are declared STRING on purpose: a feed may
send a measure as a number or as a decimal string, and a DOUBLE field would
turn the string form into NULL. ``functions.safe_double`` coerces them.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_POOLS = T.StructType(
    [
        T.StructField("snapshot_at", T.TimestampType(), False),
        T.StructField("snapshot_date", T.DateType(), False),
        T.StructField("dex_name", T.StringType(), False),
        T.StructField("pool_address", T.StringType(), False),
        T.StructField("base_token_symbol", T.StringType(), True),
        T.StructField("base_token_address", T.StringType(), True),
        T.StructField("quote_token_symbol", T.StringType(), True),
        T.StructField("quote_token_address", T.StringType(), True),
        T.StructField("trailing_24h_volume_usd", T.DoubleType(), True),
        T.StructField("trailing_24h_fees_usd", T.DoubleType(), True),
        T.StructField("tvl_usd", T.DoubleType(), True),
        T.StructField("source_file", T.StringType(), False),
    ]
)

RAW_MARKET_SHARE = T.StructType(
    [
        T.StructField("snapshot_at", T.TimestampType(), False),
        T.StructField("snapshot_date", T.DateType(), False),
        T.StructField("dex_name", T.StringType(), False),
        T.StructField("trailing_24h_volume_usd", T.DoubleType(), True),
        T.StructField("trailing_7d_volume_usd", T.DoubleType(), True),
        T.StructField("total_volume_usd", T.DoubleType(), True),
        T.StructField("source_file", T.StringType(), False),
    ]
)

POOL_COLUMNS = [f.name for f in RAW_POOLS.fields]

_TOKEN = "struct<symbol: string, address: string>"

# One pool object per feed, as the venue APIs return it.
RAYDIUM_POOL = f"struct<id: string, mintA: {_TOKEN}, mintB: {_TOKEN}, day: struct<volume: string, volumeFee: string>, tvl: string>"
ORCA_POOL = (
    f"struct<address: string, tokenA: {_TOKEN}, tokenB: {_TOKEN}, "
    "stats: struct<`24h`: struct<volume: string, fees: string>>, tvlUsdc: string>"
)
METEORA_POOL = (
    "struct<pool_address: string, pool_name: string, pool_token_mints: array<string>, "
    "trading_volume: string, fee_volume: string, pool_tvl: string>"
)
PROTOCOL = "struct<name: string, total24h: string, total7d: string, totalAllTime: string>"

# The market feed document: {"protocols": [...]}.
MARKET_DOCUMENT = f"struct<protocols: array<{PROTOCOL}>>"

# One API page per feed, before assembly.
POOL_PAGE = {
    "raydium": f"struct<data: struct<data: array<{RAYDIUM_POOL}>, hasNextPage: boolean>>",
    "orca": f"struct<data: array<{ORCA_POOL}>, meta: struct<cursor: struct<next: string>>>",
    "meteora": f"struct<data: array<{METEORA_POOL}>, total_count: bigint>",
}
