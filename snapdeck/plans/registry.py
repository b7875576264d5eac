"""Registered queries: each callable takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables through the fixtures and runs over the
whole tables. DOUBLE metrics and DECIMAL measures are presented as DOUBLE
rounded to 6 places (the oracle does the same): the two engines may differ
in the last bits of a decimal-to-double conversion, never in the first 6
places, and a double reads back the same through every result path.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck import config as _c
from snapdeck.functions import safe_double, split_pair, surrogate_key
from snapdeck.operators import checks as ck
from snapdeck.operators.joins import materialize
from snapdeck.plans import serving as sv
from snapdeck.plans import declared, dims, models, oracle as O
from snapdeck.plans import star as star_mod
from snapdeck.session import scratch_path
from snapdeck.sources import ingest as ing
from snapdeck.sources import fixtures as fx
from snapdeck.sources import lake
from snapdeck.sources import schemas as sch
from snapdeck.sources.ingest import market_rows_from_protocols
from snapdeck.streaming import alerts

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Round DOUBLE columns to 6 places for cross-engine comparison.

    Done as round(x * 1e6) / 1e6: the same IEEE steps in both engines, so an
    exact tie at the 7th place (common with fixed-decimal inputs) rounds the
    same way; ``round(x, 6)`` is rounded from the decimal expansion in Spark
    but after a multiplication in DuckDB."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            # decimal measures are presented as DOUBLE too: a double survives every
            # result path (rows, pandas, Arrow) unchanged in both engines
            x = F.col(f.name).cast("double")
            cols.append((F.round(x * F.lit(1e6)) / F.lit(1e6)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def double_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]


# --- building blocks over the fixtures ------------------------------------

def _cfg():
    return fx.fixture_config()


def raw_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.fx1_pools(spark, sf_dir)


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_pools(raw_pools(spark, sf_dir), _cfg())


def raw_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_rows_from_protocols(fx.fx2_protocols(spark, sf_dir), _cfg())


def stg_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_market_share(raw_market(spark, sf_dir), _cfg())


def pool_metrics(spark: SparkSession, sf_dir: str, stg_df: DataFrame | None = None) -> DataFrame:
    # staging is a table in the layered build; the totals and the windows both read it
    return models.pool_metrics(stg_df if stg_df is not None else materialize(stg(spark, sf_dir)), _cfg())


def fct_pool(spark: SparkSession, sf_dir: str, stg_df: DataFrame | None = None) -> DataFrame:
    return models.fct_pool(pool_metrics(spark, sf_dir, stg_df))


def fct_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fct_market_share(models.market_share_metrics(stg_ms(spark, sf_dir)))


# --- registry --------------------------------------------------------------

# Decimal measure columns per query (presented as rounded DOUBLE, as above).
_POOL_MEASURES = ["trailing_24h_volume_usd", "trailing_24h_fees_usd", "tvl_usd"]
_MS_MEASURES = ["trailing_24h_volume_usd", "trailing_7d_volume_usd", "total_volume_usd"]
DECIMAL_MEASURES = {
    "stg_pools": _POOL_MEASURES,
    "pool_metrics": _POOL_MEASURES + ["dex_total_24h_volume", "market_total_24h_volume"],
    "pool_metrics_incremental": _POOL_MEASURES + ["dex_total_24h_volume", "market_total_24h_volume"],
    "fct_pool": _POOL_MEASURES + ["dex_total_24h_volume", "market_total_24h_volume"],
    "stg_market_share": _MS_MEASURES,
    "market_share_metrics": _MS_MEASURES + ["total_market_24h_volume"],
    "fct_market_share": _MS_MEASURES + ["total_market_24h_volume"],
    "dim_pool": ["lifetime_observed_volume_usd", "lifetime_observed_fees_usd"],
    "star_pool_token_date": ["trailing_24h_volume_usd"],
    "top_pools_by_fees": ["trailing_24h_fees_usd", "trailing_24h_volume_usd"],
    "capital_efficiency": ["trailing_24h_volume_usd", "tvl_usd"],
    "pool_trajectory": ["trailing_24h_volume_usd"],
    "venue_volume": ["trailing_24h_volume_usd"],
    "venue_current": ["trailing_24h_volume_usd"],
    "quality_floor": _POOL_MEASURES,
}

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None, doubles: list[str] | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = O.rounded(sql, (doubles or []) + DECIMAL_MEASURES.get(name, []))
        return run

    return deco


PM_DOUBLES = [
    "pool_share_of_dex_pct",
    "pool_share_of_market_pct",
    "fee_rate_pct",
    "volume_to_tvl_ratio",
    "volume_7d_avg",
    "volume_wow_pct_change",
]
MS_DOUBLES = ["dex_market_share_pct", "share_7d_avg", "share_change_vs_7d_avg_pct"]


@register("stg_pools", O.with_ctes("SELECT * FROM stg", O.FX1, O.STG))
def q_stg_pools(spark, sf_dir):
    """M1 (P1, P2) over FX1."""
    return stg(spark, sf_dir)


@register("pool_metrics", O.with_ctes("SELECT * FROM pm", O.FX1, O.STG, O.PM), PM_DOUBLES)
def q_pool_metrics(spark, sf_dir):
    """M3 (W1-W4, P5-P9)."""
    return pool_metrics(spark, sf_dir)


@register("fct_pool", O.with_ctes("SELECT * FROM fct", O.FX1, O.STG, O.PM, O.FCT), PM_DOUBLES)
def q_fct_pool(spark, sf_dir):
    """M5 (P12, P13)."""
    return fct_pool(spark, sf_dir)


@register("stg_market_share", O.with_ctes("SELECT * FROM stg_ms", O.FX2, O.RAW_MS, O.STG_MS))
def q_stg_market_share(spark, sf_dir):
    """M2 (I11, P3, P4, A1) over FX2."""
    return stg_ms(spark, sf_dir)


@register("market_share_metrics", O.with_ctes("SELECT * FROM msm", O.FX2, O.RAW_MS, O.STG_MS, O.MSM), MS_DOUBLES)
def q_market_share_metrics(spark, sf_dir):
    """M4 (W5, W6, P10, P11)."""
    return models.market_share_metrics(stg_ms(spark, sf_dir))


@register("fct_market_share", O.with_ctes("SELECT * FROM fct_ms", O.FX2, O.RAW_MS, O.STG_MS, O.MSM, O.FCT_MS), MS_DOUBLES)
def q_fct_market_share(spark, sf_dir):
    """M6 (P12, P14)."""
    return fct_ms(spark, sf_dir)


@register("dim_pool", O.with_ctes("SELECT * FROM dim_pool", O.FX1, O.STG, O.DIM_POOL))
def q_dim_pool(spark, sf_dir):
    """D3 (W7, A2, J1)."""
    return dims.dim_pool(stg(spark, sf_dir))


@register("dim_token", O.with_ctes("SELECT * FROM dim_token", O.FX1, O.STG, O.DIM_TOKEN))
def q_dim_token(spark, sf_dir):
    """D4 (P15, U1, W8, A3, J2)."""
    return dims.dim_token(stg(spark, sf_dir))


@register("dim_date", O.with_ctes("SELECT * FROM dim_date", O.FX1, O.DIM_DATE))
def q_dim_date(spark, sf_dir):
    """D1, D2 (F10-F15): calendar from the staging start to the last run + 365 days."""
    return dims.date_dim_for(raw_pools(spark, sf_dir), _cfg())


@register(
    "star_pool_token_date",
    O.with_ctes("SELECT * FROM star", O.FX1, O.STG, O.PM, O.FCT, O.DIM_POOL, O.DIM_TOKEN, O.DIM_DATE, O.STAR),
    ["fee_rate_pct", "pool_share_of_market_pct"],
)
def q_star(spark, sf_dir):
    """Fact to pool, token (twice, LEFT) and date dimensions."""
    return star_mod.star_pool_token_date(spark, sf_dir)


# --- checks (C1-C10) -------------------------------------------------------


AS_OF_TS = _dt.datetime.fromisoformat(fx.FIXTURE_AS_OF).replace(tzinfo=_dt.timezone.utc)
POOL_NOT_NULL = declared.NOT_NULL["stg_dex_pools"]


def as_of_col():
    return F.lit(AS_OF_TS)


_CTE_OF = {
    "raw_dex_pools": "fx1", "raw_dex_market_share": "raw_ms", "stg_dex_pools": "stg", "stg_dex_market_share": "stg_ms",
    "fct_pool_trailing_24h": "fct", "fct_dex_market_share_daily": "fct_ms", "dim_pool": "dim_pool", "dim_token": "dim_token",
    "dim_date": "dim_date",
}
_ALL_CTES = (O.FX1, O.STG, O.PM, O.FCT, O.FX2, O.RAW_MS, O.STG_MS, O.MSM, O.FCT_MS, O.DIM_POOL, O.DIM_TOKEN, O.DIM_DATE)


def _all_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Every raw table and model that carries declarations."""
    raw = raw_pools(spark, sf_dir)
    s = materialize(models.stg_pools(raw, _cfg()))
    return {
        "raw_dex_pools": raw,
        "raw_dex_market_share": raw_market(spark, sf_dir),
        "stg_dex_pools": s,
        "stg_dex_market_share": stg_ms(spark, sf_dir),
        "fct_pool_trailing_24h": fct_pool(spark, sf_dir, s),
        "fct_dex_market_share_daily": fct_ms(spark, sf_dir),
        "dim_pool": dims.dim_pool(s),
        "dim_token": dims.dim_token(s),
        "dim_date": QUERIES["dim_date"](spark, sf_dir),
    }


@register(
    "check_not_null",
    O.with_ctes(
        "\nUNION ALL\n".join(
            O.row_suite_sql(name, _CTE_OF[name], O.not_null_tests(cols)) for name, cols in declared.NOT_NULL.items()
        ),
        *_ALL_CTES,
    ),
)
def q_check_not_null(spark, sf_dir):
    """All 28 declarations, one aggregate pass per table."""
    return declared.not_null_results(_all_tables(spark, sf_dir))


O_CHECK_CTES = (O.FX1, O.STG, O.PM, O.FCT)


@register(
    "check_accepted_values",
    O.with_ctes(
        O.row_suite_sql("raw_dex_pools", "fx1", [O.accepted_test("dex_name", _c.POOL_VENUES)])
        + "\nUNION ALL\n"
        + O.row_suite_sql("stg_dex_pools", "stg", [O.accepted_test("dex_name", _c.POOL_VENUES)])
        + "\nUNION ALL\n"
        + O.row_suite_sql("fct_pool_trailing_24h", "fct", [O.accepted_test("dex_name", _c.POOL_VENUES)]),
        *O_CHECK_CTES,
    ),
)
def q_check_accepted_values(spark, sf_dir):
    """dex_name in the tracked venues on raw, staging and fact."""
    raw = raw_pools(spark, sf_dir)
    s = models.stg_pools(raw, _cfg())
    t = [ck.accepted_values("dex_name", _c.POOL_VENUES)]
    return (
        ck.row_level_suite(raw, "raw_dex_pools", t)
        .unionByName(ck.row_level_suite(s, "stg_dex_pools", t))
        .unionByName(ck.row_level_suite(models.fct_pool(models.pool_metrics(s, _cfg())), "fct_pool_trailing_24h", t))
    )


@register(
    "check_unique",
    O.with_ctes(
        "\nUNION ALL\n".join(
            O.unique_sql(name, _CTE_OF[name], [c]) for name, cols in declared.UNIQUE.items() for c in cols
        ),
        *_ALL_CTES,
    ),
)
def q_check_unique(spark, sf_dir):
    """All 8 declared keys of facts and dimensions."""
    return declared.unique_results(_all_tables(spark, sf_dir))


@register(
    "check_unique_combination",
    O.with_ctes(
        O.unique_sql("stg_dex_pools", "stg", ["snapshot_date", "dex_name", "pool_address"])
        + "\nUNION ALL\n"
        + O.unique_sql("stg_dex_market_share", "stg_ms", ["snapshot_date", "dex_name"]),
        O.FX1, O.STG, O.FX2, O.RAW_MS, O.STG_MS,
    ),
)
def q_check_unique_combination(spark, sf_dir):
    """C4 on both staging models."""
    return ck.unique_combination(stg(spark, sf_dir), "stg_dex_pools", ["snapshot_date", "dex_name", "pool_address"]).unionByName(
        ck.unique_combination(stg_ms(spark, sf_dir), "stg_dex_market_share", ["snapshot_date", "dex_name"])
    )


@register(
    "check_no_future",
    O.with_ctes(O.row_suite_sql("stg_dex_pools", "stg", [("no_future", "snapshot_date", f"snapshot_date > CAST({O.AS_OF} AS DATE)")]), O.FX1, O.STG),
)
def q_check_no_future(spark, sf_dir):
    """No snapshot dated after as_of."""
    return ck.row_level_suite(stg(spark, sf_dir), "stg_dex_pools", [ck.no_future("snapshot_date", F.to_date(as_of_col()))])


@register(
    "check_no_negative_volume",
    O.with_ctes(O.row_suite_sql("stg_dex_pools", "stg", [("no_negative", "trailing_24h_volume_usd", "trailing_24h_volume_usd < 0")]), O.FX1, O.STG),
)
def q_check_no_negative_volume(spark, sf_dir):
    """C6."""
    return ck.row_level_suite(stg(spark, sf_dir), "stg_dex_pools", [ck.no_negative("trailing_24h_volume_usd")])


@register(
    "check_suite_stg_pools",
    O.with_ctes(
        O.row_suite_sql(
            "stg_dex_pools",
            "stg",
            O.not_null_tests(POOL_NOT_NULL)
            + [
                O.accepted_test("dex_name", _c.POOL_VENUES),
                ("no_future", "snapshot_date", f"snapshot_date > CAST({O.AS_OF} AS DATE)"),
                ("no_negative", "trailing_24h_volume_usd", "trailing_24h_volume_usd < 0"),
            ],
        ),
        O.FX1,
        O.STG,
    ),
)
def q_check_suite_stg_pools(spark, sf_dir):
    """C1, C3, C5, C6 of the staging model in ONE scan and aggregate."""
    tests = ck.not_null(POOL_NOT_NULL) + [
        ck.accepted_values("dex_name", _c.POOL_VENUES),
        ck.no_future("snapshot_date", F.to_date(as_of_col())),
        ck.no_negative("trailing_24h_volume_usd"),
    ]
    return ck.row_level_suite(stg(spark, sf_dir), "stg_dex_pools", tests)


@register("check_pools_all_dexes_latest", O.with_ctes(O.latest_distinct_sql("stg", "dex_name", 3), O.FX1, O.STG))
def q_check_pools_all_dexes_latest(spark, sf_dir):
    """A row (the venue count) only when the latest pool snapshot misses a venue."""
    return ck.latest_min_distinct(stg(spark, sf_dir), "dex_name", _c.MIN_LATEST_VENUES)


@register(
    "check_market_all_dexes_latest",
    O.with_ctes(O.latest_distinct_sql("fct_ms", "dex_name", 3), O.FX2, O.RAW_MS, O.STG_MS, O.MSM, O.FCT_MS),
)
def q_check_market_all_dexes_latest(spark, sf_dir):
    """C8."""
    return ck.latest_min_distinct(fct_ms(spark, sf_dir), "dex_name", _c.MIN_LATEST_VENUES)


@register("check_pools_min_rows_latest", O.with_ctes(O.latest_rows_sql("stg", 50), O.FX1, O.STG))
def q_check_pools_min_rows_latest(spark, sf_dir):
    """Fires on the fixture (its last day has fewer than 50 pools)."""
    return ck.latest_min_rows(stg(spark, sf_dir), _c.MIN_LATEST_ROWS)


@register(
    "check_freshness",
    O.with_ctes(O.freshness_sql({"raw_dex_pools": "fx1", "raw_dex_market_share": "raw_ms"}, 26, 48), O.FX1, O.FX2, O.RAW_MS),
)
def q_check_freshness(spark, sf_dir):
    """C10 over both raw tables at a fixed as_of."""
    return ck.freshness(
        {"raw_dex_pools": raw_pools(spark, sf_dir), "raw_dex_market_share": raw_market(spark, sf_dir)},
        as_of_col(),
        _c.FRESH_WARN_HOURS,
        _c.FRESH_ERROR_HOURS,
    )


# --- serving (V1-V12) ------------------------------------------------------

@register(
    "status_freshness",
    O.with_ctes(
        f"SELECT h AS hours_since_last_snapshot, {O.band_sql('h')} AS status FROM "
        f"(SELECT CAST(date_sub('hour', MAX(snapshot_at), {O.AS_OF}) AS BIGINT) AS h FROM fx1) AS _h",
        O.FX1,
    ),
)
def q_status_freshness(spark, sf_dir):
    """V1 (A9, F17, P16)."""
    return sv.hours_since_last_snapshot(raw_pools(spark, sf_dir), as_of_col())


@register(
    "status_tables",
    O.with_ctes(
        "SELECT * FROM (SELECT 'raw_dex_pools' AS tbl, MAX(snapshot_date) AS last_snapshot, COUNT(*) AS rows_total FROM fx1 "
        "UNION ALL SELECT 'raw_dex_market_share', MAX(snapshot_date), COUNT(*) FROM raw_ms "
        "UNION ALL SELECT 'fct_pool_trailing_24h', MAX(snapshot_date), COUNT(*) FROM fct "
        "UNION ALL SELECT 'fct_dex_market_share_daily', MAX(snapshot_date), COUNT(*) FROM fct_ms) AS _t ORDER BY tbl",
        O.FX1, O.STG, O.PM, O.FCT, O.FX2, O.RAW_MS, O.STG_MS, O.MSM, O.FCT_MS,
    ),
)
def q_status_tables(spark, sf_dir):
    """V2 (A8, U2, O3)."""
    return sv.table_status(
        {
            "raw_dex_pools": raw_pools(spark, sf_dir),
            "raw_dex_market_share": raw_market(spark, sf_dir),
            # the facts have the rows of their staging tables (M3-M6 add columns only)
            "fct_pool_trailing_24h": stg(spark, sf_dir),
            "fct_dex_market_share_daily": stg_ms(spark, sf_dir),
        }
    )


@register(
    "status_rows_vs_7d",
    O.with_ctes(
        "SELECT (SELECT c FROM daily ORDER BY snapshot_date DESC LIMIT 1) AS rows_today, "
        "(SELECT ROUND(AVG(c)) FROM (SELECT c FROM daily ORDER BY snapshot_date DESC LIMIT 7) AS _l) AS rows_7d_avg",
        O.FX1,
        "daily AS (SELECT snapshot_date, COUNT(*) AS c FROM fx1 GROUP BY snapshot_date)",
    ),
    ["rows_7d_avg"],
)
def q_status_rows_vs_7d(spark, sf_dir):
    """V3 (A6, A7, O1, O2, J4)."""
    return sv.rows_vs_7d(raw_pools(spark, sf_dir))


_TOP_FEES_COLS = ["snapshot_date", "dex_name", "pool_address", "base_token_symbol", "quote_token_symbol", "trailing_24h_fees_usd", "trailing_24h_volume_usd", "fee_rate_pct"]
_EFF_COLS = ["snapshot_date", "dex_name", "pool_address", "trailing_24h_volume_usd", "tvl_usd", "volume_to_tvl_ratio"]


@register(
    "top_pools_by_fees",
    O.with_ctes(O.top_latest_sql("fct", "trailing_24h_fees_usd", _TOP_FEES_COLS, "fee_rank", 10), O.FX1, O.STG, O.PM, O.FCT),
    ["fee_rate_pct"],
)
def q_top_pools_by_fees(spark, sf_dir):
    """V5 (J3, O5): top 10 pools by fees in the latest snapshot."""
    return sv.top_pools_by_fees(models.row_metrics(stg(spark, sf_dir)), 10)


FEE_RATE_MIN_DAYS = 400


@register(
    "fee_rates",
    O.with_ctes(
        "SELECT p.pool_address, p.dex_name, p.snapshot_days_count, f.avg_fee_rate_pct, "
        "CASE WHEN p.lifetime_observed_volume_usd > 0 THEN CAST(p.lifetime_observed_fees_usd AS DOUBLE) / "
        "CAST(p.lifetime_observed_volume_usd AS DOUBLE) * 100 ELSE 0.0 END AS lifetime_fee_rate_pct "
        "FROM dim_pool p JOIN (SELECT pool_key, AVG(fee_rate_pct) AS avg_fee_rate_pct FROM fct GROUP BY pool_key) f "
        f"ON p.pool_key = f.pool_key WHERE p.snapshot_days_count >= {FEE_RATE_MIN_DAYS}",
        O.FX1, O.STG, O.PM, O.FCT, O.DIM_POOL,
    ),
    ["avg_fee_rate_pct", "lifetime_fee_rate_pct"],
)
def q_fee_rates(spark, sf_dir):
    """V6 (J5): fee rates of established pools (seen on >= 400 days)."""
    s = materialize(stg(spark, sf_dir))
    # fee rates are row by row: no totals, no frames
    rated = models.row_metrics(s).select(surrogate_key("pool_address").alias("pool_key"), "fee_rate_pct")
    return sv.fee_rates_established(rated, dims.dim_pool(s), FEE_RATE_MIN_DAYS)


@register(
    "capital_efficiency",
    O.with_ctes(O.top_latest_sql("fct", "volume_to_tvl_ratio", _EFF_COLS, "efficiency_rank", 10), O.FX1, O.STG, O.PM, O.FCT),
    ["volume_to_tvl_ratio"],
)
def q_capital_efficiency(spark, sf_dir):
    """V7 (J3, O5)."""
    return sv.capital_efficiency(models.row_metrics(stg(spark, sf_dir)), 10)


@register(
    "pool_trajectory",
    O.with_ctes(
        "SELECT snapshot_date, pool_address, dex_name, trailing_24h_volume_usd, volume_7d_avg FROM fct "
        "WHERE pool_key = (SELECT pool_key FROM dim_pool ORDER BY lifetime_observed_volume_usd DESC NULLS LAST, pool_address ASC LIMIT 1)",
        O.FX1, O.STG, O.PM, O.FCT, O.DIM_POOL,
    ),
    ["volume_7d_avg"],
)
def q_pool_trajectory(spark, sf_dir):
    """V8: daily volume and 7-row average of the pool with the largest lifetime volume."""
    s = materialize(stg(spark, sf_dir))
    return sv.pool_trajectory(fct_pool(spark, sf_dir, s), dim_pool=dims.dim_pool(s))


_MS_CTES = (O.FX2, O.RAW_MS, O.STG_MS, O.MSM, O.FCT_MS)


@register("venue_volume", O.with_ctes("SELECT snapshot_date, dex_name, trailing_24h_volume_usd FROM fct_ms", *_MS_CTES))
def q_venue_volume(spark, sf_dir):
    """V9."""
    return sv.venue_volume(fct_ms(spark, sf_dir))


@register(
    "share_over_time",
    O.with_ctes("SELECT snapshot_date, dex_name, dex_market_share_pct, share_7d_avg FROM fct_ms", *_MS_CTES),
    ["dex_market_share_pct", "share_7d_avg"],
)
def q_share_over_time(spark, sf_dir):
    """V10."""
    return sv.share_over_time(fct_ms(spark, sf_dir))


@register(
    "venue_current",
    O.with_ctes(
        "SELECT snapshot_date, dex_name, trailing_24h_volume_usd, dex_market_share_pct FROM fct_ms "
        "WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM fct_ms)",
        *_MS_CTES,
    ),
    ["dex_market_share_pct"],
)
def q_venue_current(spark, sf_dir):
    """V11 (J3)."""
    return sv.venue_current(fct_ms(spark, sf_dir))


@register(
    "share_change",
    O.with_ctes(
        "SELECT snapshot_date, dex_name, dex_market_share_pct, share_7d_avg, share_change_vs_7d_avg_pct, "
        "CASE WHEN share_change_vs_7d_avg_pct > 0 THEN 'gaining' WHEN share_change_vs_7d_avg_pct < 0 THEN 'losing' ELSE 'flat' END AS trend "
        "FROM fct_ms WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM fct_ms) ORDER BY share_change_vs_7d_avg_pct DESC",
        *_MS_CTES,
    ),
    MS_DOUBLES,
)
def q_share_change(spark, sf_dir):
    """V12 (J3)."""
    return sv.share_change(fct_ms(spark, sf_dir))


# --- ingest (I1-I13, S2) -------------------------------------------------------

_PAGES_CTES = (O.FX1, O.pages_ctes())
RAW_DOUBLES = ["trailing_24h_volume_usd", "trailing_24h_fees_usd", "tvl_usd"]


def _pages(spark, sf_dir):
    """The landed pages and their manifest. Landed data is data at rest, so
    the fixture is materialized once instead of being re-derived per stage."""
    pages = materialize(fx.fx5_pages(spark, sf_dir))
    return pages, fx.manifest_from_pages(pages)


def _parse(source):
    def q(spark, sf_dir):
        pages, manifest = _pages(spark, sf_dir)
        return ing.ingest_pool_pages(pages, manifest, source, _cfg())

    q.__doc__ = f"I1, I3-I5, I7, I8, I12 for the {source} feed: landed pages -> raw pool rows."
    return q


for _src in ("raydium", "orca", "meteora"):
    register(f"parse_{_src}", O.with_ctes(O.parsed_sql(f"source = '{_src}'"), *_PAGES_CTES), RAW_DOUBLES)(_parse(_src))


@register("union_sources", O.with_ctes(O.parsed_sql("TRUE"), *_PAGES_CTES), RAW_DOUBLES)
def q_union_sources(spark, sf_dir):
    """The three venues' rows as one raw table."""
    pages, manifest = _pages(spark, sf_dir)
    return ing.ingest_all_pools(pages, manifest, _cfg())


@register("page_stop_at_floor", O.with_ctes("SELECT * FROM pg_status", *_PAGES_CTES))
def q_page_stop_at_floor(spark, sf_dir):
    """Per landed page, whether it stops its feed and whether it is kept."""
    pages, _ = _pages(spark, sf_dir)
    metas = [ing.page_meta(ing.parse_pages(pages, s), s, _cfg()) for s in ("raydium", "orca", "meteora")]
    status = ing.page_status(metas[0].unionByName(metas[1]).unionByName(metas[2]), _cfg())
    return status.select("source", "snapshot_date", "page_no", F.col("n_items").cast("long").alias("n_items"), "is_stop", "kept")


@register(
    "dedup_first",
    O.with_ctes("SELECT snapshot_date, pool_address, page_no, pos FROM pg_kept_items WHERE source = 'orca'", *_PAGES_CTES),
)
def q_dedup_first(spark, sf_dir):
    """Orca pools after first-occurrence dedup (the repeated page adds none)."""
    _, items = ing.assemble_pages(_pages(spark, sf_dir)[0], "orca", _cfg())
    return items.select("snapshot_date", F.col("item.address").alias("pool_address"), F.col("page_no").cast("long").alias("page_no"), F.col("pos").cast("long").alias("pos"))


@register(
    "parse_market_share",
    O.with_ctes(
        "SELECT snapshot_at, snapshot_date, dex_name, CAST(trailing_24h_volume_usd AS DOUBLE) AS trailing_24h_volume_usd, "
        "CAST(trailing_7d_volume_usd AS DOUBLE) AS trailing_7d_volume_usd, CAST(total_volume_usd AS DOUBLE) AS total_volume_usd, "
        "'raw/dex_market_share/date=' || CAST(snapshot_date AS VARCHAR) || '/defillama_' || strftime(snapshot_date, '%Y%m%d') || '.json' AS source_file "
        "FROM raw_ms",
        O.FX2,
        O.RAW_MS,
    ),
    ["trailing_24h_volume_usd", "trailing_7d_volume_usd", "total_volume_usd"],
)
def q_parse_market_share(spark, sf_dir):
    """I6, I11, I12 from JSON documents (numbers and numeric strings)."""
    return ing.parse_market_documents(fx.fx4_market_documents(spark, sf_dir), _cfg())


@register(
    "quality_floor",
    O.with_ctes(
        "SELECT * FROM fx1 WHERE COALESCE(trailing_24h_volume_usd, 0) >= 1000 AND COALESCE(tvl_usd, 0) >= 1000",
        O.FX1,
    ),
)
def q_quality_floor(spark, sf_dir):
    """I8 over the raw pool rows: volume and TVL at or above the floor, NULL as 0."""
    return ing.quality_floor(raw_pools(spark, sf_dir), _cfg())


def _numeric_texts(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    p = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    form = F.col("l_linenumber") % 7
    text = (
        F.when(form == 0, p)
        .when(form == 1, F.concat(F.lit("  "), p, F.lit(" ")))
        .when(form == 2, F.concat(p, F.lit("e-2")))
        .when(form == 3, F.concat(p, F.lit("d")))
        .when(form == 4, F.lit("NaN"))
        .when(form == 5, F.regexp_replace(p, r"\.", "_"))
        .otherwise(F.lit(None).cast("string"))
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("text"))


_NUM_TEXT_SQL = """num_texts AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber % 7
      WHEN 0 THEN p WHEN 1 THEN '  ' || p || ' ' WHEN 2 THEN p || 'e-2' WHEN 3 THEN p || 'd'
      WHEN 4 THEN 'NaN' WHEN 5 THEN replace(p, '.', '_') ELSE NULL END AS text
  FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS p FROM lineitem) AS _p
)"""


@register(
    "safe_double",
    O.with_ctes(f"SELECT l_orderkey, l_linenumber, text, {O.safe_double_sql('text')} AS value FROM num_texts", _NUM_TEXT_SQL),
    ["value"],
)
def q_safe_double(spark, sf_dir):
    """Numeric coercion of texts derived from every line item (plain,
    padded, scientific, Spark-only suffix, NaN, digit separators, NULL)."""
    return _numeric_texts(spark, sf_dir).withColumn("value", safe_double("text"))


_PAIR_SQL = """pairs AS (
  SELECT pool_address, snapshot_date,
    CASE CAST(substr(pool_address, 5) AS BIGINT) % 5
      WHEN 0 THEN base_token_symbol || '-' || quote_token_symbol
      WHEN 1 THEN '-' || quote_token_symbol
      WHEN 2 THEN base_token_symbol || '-'
      WHEN 3 THEN base_token_symbol || '-' || quote_token_symbol || '-X'
      ELSE base_token_symbol END AS pool_name
  FROM fx1
)"""


@register(
    "split_pair",
    O.with_ctes(
        "SELECT pool_address, snapshot_date, pool_name, "
        "CASE WHEN position('-' IN pool_name) > 0 THEN CASE WHEN position('-' IN pool_name) = 1 THEN 'UNKNOWN' "
        "ELSE substr(pool_name, 1, position('-' IN pool_name) - 1) END END AS base_symbol, "
        "CASE WHEN position('-' IN pool_name) > 0 THEN NULLIF(substr(pool_name, position('-' IN pool_name) + 1), '') END AS quote_symbol "
        "FROM pairs",
        O.FX1,
        _PAIR_SQL,
    ),
)
def q_split_pair(spark, sf_dir):
    """Pair names (derived per pool: full, no base, no quote, extra dash, no dash) split on the first '-'."""
    raw = raw_pools(spark, sf_dir)
    form = F.substring("pool_address", 5, 100).cast("long") % 5
    b, q = F.col("base_token_symbol"), F.col("quote_token_symbol")
    name = (
        F.when(form == 0, F.concat(b, F.lit("-"), q))
        .when(form == 1, F.concat(F.lit("-"), q))
        .when(form == 2, F.concat(b, F.lit("-")))
        .when(form == 3, F.concat(b, F.lit("-"), q, F.lit("-X")))
        .otherwise(b)
    )
    named = raw.select("pool_address", "snapshot_date", name.alias("pool_name"))
    base, quote = split_pair("pool_name")
    return named.select("pool_address", "snapshot_date", "pool_name", base.alias("base_symbol"), quote.alias("quote_symbol"))


# --- lake, slice loads, retention, storage (S1-S14, V4) ------------------------


def _stale(raw: DataFrame) -> DataFrame:
    """An older landing of the same slices (tagged in source_file, volumes halved)."""
    return raw.withColumn("source_file", F.concat(F.lit("stale/"), "source_file")).withColumn(
        "trailing_24h_volume_usd", (F.col("trailing_24h_volume_usd") / 2).cast("decimal(38,9)")
    )


_RAW_COLS = ", ".join(sch.POOL_COLUMNS)
_RAW_AS_TABLE = (
    "SELECT snapshot_at, snapshot_date, dex_name, pool_address, base_token_symbol, base_token_address, "
    "quote_token_symbol, quote_token_address, CAST(trailing_24h_volume_usd AS DOUBLE) AS trailing_24h_volume_usd, "
    "CAST(trailing_24h_fees_usd AS DOUBLE) AS trailing_24h_fees_usd, CAST(tvl_usd AS DOUBLE) AS tvl_usd, source_file FROM {src}"
)
_STALE_SQL = """stale AS (
  SELECT snapshot_at, snapshot_date, dex_name, pool_address, base_token_symbol, base_token_address,
    quote_token_symbol, quote_token_address, CAST(trailing_24h_volume_usd / 2 AS DECIMAL(38,9)) AS trailing_24h_volume_usd,
    trailing_24h_fees_usd, tvl_usd, 'stale/' || source_file AS source_file
  FROM fx1
)"""


@register(
    "slice_load_skip",
    O.with_ctes(
        _RAW_AS_TABLE.format(src="stale WHERE dex_name IN ('raydium', 'orca')")
        + " UNION ALL "
        + _RAW_AS_TABLE.format(src="fx1 WHERE dex_name = 'meteora'"),
        O.FX1,
        _STALE_SQL,
    ),
    RAW_DOUBLES,
)
def q_slice_load_skip(spark, sf_dir):
    """An older load holds raydium/orca; reloading every slice
    without overwrite skips those and appends only meteora's."""
    raw = materialize(raw_pools(spark, sf_dir))  # both loads take their rows from it
    path = scratch_path(spark, "raw_dex_pools")
    lake.load_slices(_stale(raw).filter(F.col("dex_name").isin("raydium", "orca")), path, overwrite=False, schema=sch.RAW_POOLS, stored=True)
    lake.load_slices(raw, path, overwrite=False, schema=sch.RAW_POOLS, stored=True)
    return spark.read.parquet(path).select(*sch.POOL_COLUMNS)


@register(
    "slice_load_overwrite",
    O.with_ctes(
        _RAW_AS_TABLE.format(src="stale WHERE dex_name <> 'raydium'") + " UNION ALL " + _RAW_AS_TABLE.format(src="fx1 WHERE dex_name = 'raydium'"),
        O.FX1,
        _STALE_SQL,
    ),
    RAW_DOUBLES,
)
def q_slice_load_overwrite(spark, sf_dir):
    """Overwrite replaces exactly the reloaded (raydium) slices; the
    other venues' slices stay as they were."""
    raw = materialize(raw_pools(spark, sf_dir))  # both loads take their rows from it
    path = scratch_path(spark, "raw_dex_pools")
    lake.load_slices(_stale(raw), path, overwrite=False, schema=sch.RAW_POOLS, stored=True)
    lake.load_slices(raw.filter(F.col("dex_name") == "raydium"), path, overwrite=True, schema=sch.RAW_POOLS, stored=True)
    return spark.read.parquet(path).select(*sch.POOL_COLUMNS)


def _landed(spark, sf_dir):
    root = scratch_path(spark, "lake")
    # the range sample and the write read them
    lake.land_pages(materialize(fx.fx5_pages(spark, sf_dir)), root)
    return lake.read_landed_pages(spark, root)


def _items_in_page() -> "F.Column":
    return lake.page_record_count(F.col("source"), F.col("body"))


@register(
    "landing_manifest",
    O.with_ctes(
        "SELECT source, snapshot_date, CAST(COUNT(*) AS BIGINT) AS pages, CAST(SUM(n_items) AS BIGINT) AS raw_record_count, "
        "CAST(snapshot_date AS TIMESTAMP) + INTERVAL 26 HOUR AS snapshot_at FROM pg_pages GROUP BY source, snapshot_date",
        *_PAGES_CTES,
    ),
)
def q_landing_manifest(spark, sf_dir):
    """Land every page as JSON lines under dex=/date=, read the lake
    back and derive each slice's manifest row (pages, pool records, run time)."""
    landed = _landed(spark, sf_dir)
    m = landed.groupBy("source", "snapshot_date").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(_items_in_page()).cast("long").alias("raw_record_count")
    )
    return m.withColumn("snapshot_at", fx.run_stamp(F.col("snapshot_date")))


@register(
    "retention_expired",
    O.with_ctes(
        f"SELECT source, snapshot_date FROM pg_slices WHERE snapshot_date + 1 <= CAST({O.AS_OF} AS DATE) - 90",
        *_PAGES_CTES,
    ),
)
def q_retention_expired(spark, sf_dir):
    """Landed slices whose age at as_of reached the 90-day retention,
    read from the landing manifest (the rule consults the manifest, not a
    listing of the lake)."""
    _, manifest = _pages(spark, sf_dir)
    return lake.expired_slices(manifest, as_of_col(), _c.RETENTION_DAYS).select("source", "snapshot_date")


@register(
    "status_storage",
    O.with_ctes(
        "\nUNION ALL\n".join(
            [
                "SELECT 'snap_raw' AS table_schema, 'raw_dex_pools' AS table_name, 'TABLE' AS table_type, "
                "CAST(COUNT(*) AS BIGINT) AS total_rows, COUNT(*) > 0 AS has_bytes FROM fx1",
                "SELECT 'snap_raw', 'raw_dex_market_share', 'TABLE', CAST(COUNT(*) AS BIGINT), COUNT(*) > 0 FROM raw_ms",
                "SELECT 'snap_marts', 'fct_pool_trailing_24h', 'VIEW', CAST(0 AS BIGINT), FALSE",
                "SELECT 'snap_marts', 'fct_dex_market_share_daily', 'VIEW', CAST(0 AS BIGINT), FALSE",
            ]
        ),
        O.FX1, O.FX2, O.RAW_MS,
    ),
)
def q_status_storage(spark, sf_dir):
    """V4: storage by table (schema, name, type, rows, any bytes) over the
    tables a load wrote; views hold no bytes. How many bytes depends on the
    writer, so the query shows whether there are any."""
    root = scratch_path(spark, "warehouse")
    raw = materialize(raw_pools(spark, sf_dir))  # the load and the view's totals read it
    lake.load_slices(raw, f"{root}/raw_dex_pools", schema=sch.RAW_POOLS, stored=True)
    lake.load_slices(
        raw_market(spark, sf_dir), f"{root}/raw_dex_market_share", slice_keys=("snapshot_date",), cluster=("dex_name",), schema=sch.RAW_MARKET_SHARE
    )
    stored = sv.storage_by_table(
        spark,
        {
            ("snap_raw", "raw_dex_pools"): f"{root}/raw_dex_pools",
            ("snap_raw", "raw_dex_market_share"): f"{root}/raw_dex_market_share",
        },
        {("snap_marts", "fct_pool_trailing_24h"): fct_pool(spark, sf_dir, models.stg_pools(raw, _cfg())), ("snap_marts", "fct_dex_market_share_daily"): fct_ms(spark, sf_dir)},
    )
    return stored.withColumn("has_bytes", F.col("bytes") > 0).drop("bytes")


# --- streaming alert (A10, ST1) ------------------------------------------------

_ALERT_SQL = (
    "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, "
    "CAST(COUNT(*) FILTER (WHERE lower(event_type) = 'error') AS BIGINT) AS error_count, "
    "COUNT(*) FILTER (WHERE lower(event_type) = 'error') > 0 AS alert "
    "FROM events GROUP BY 1, 2"
)


@register("error_alert_hourly", _ALERT_SQL)
def q_error_alert_hourly(spark, sf_dir):
    """A10/ST1 batch form: error events per aligned hour, alert when > 0."""
    return alerts.hourly_error_counts(fx.table(spark, sf_dir, "events"))


@register("error_alert_stream", _ALERT_SQL)
def q_error_alert_stream(spark, sf_dir):
    """ST1 as a stream: events replayed as time-ordered daily files through the
    watermarked windowed count in update mode; final state per window."""
    return alerts.replay_alert_stream(spark, fx.table(spark, sf_dir, "events"), scratch_path(spark, "alert_stream"))


@register(
    "landing_missing",
    O.with_ctes(
        "SELECT DISTINCT dex_name AS source, snapshot_date FROM fx1 "
        "EXCEPT SELECT DISTINCT dex_name, snapshot_date FROM fx1 WHERE trailing_24h_volume_usd IS NOT NULL",
        O.FX1,
    ),
)
def q_landing_missing(spark, sf_dir):
    """Requested (venue, day) slices with no landed pages (a feed whose
    every pool lacked a volume lands nothing)."""
    requested = raw_pools(spark, sf_dir).select(F.col("dex_name").alias("source"), "snapshot_date").distinct()
    landed = fx.fx5_manifest(spark, sf_dir)
    return lake.missing_slices(requested, landed)


@register(
    "pool_metrics_incremental",
    O.with_ctes("SELECT * FROM pm WHERE snapshot_date >= (SELECT MAX(snapshot_date) FROM stg) - 29", O.FX1, O.STG, O.PM),
    PM_DOUBLES,
)
def q_pool_metrics_incremental(spark, sf_dir):
    """M3 rebuilt incrementally for the last 30 snapshot days: the new rows
    plus each pool's last 7 earlier rows, equal to the full rebuild there."""
    s = materialize(stg(spark, sf_dir))
    since = F.date_sub(s.select(F.max("snapshot_date")).scalar(), 29)
    return models.pool_metrics_since(s, since, _cfg())


from snapdeck.plans import registry_loads  # noqa: E402, F401 - registers its queries
